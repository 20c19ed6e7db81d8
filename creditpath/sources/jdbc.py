"""JDBC sources and sinks (connection details are always parameters).

Spark pushes filters and the column list of a JDBC scan down to the database.
Writes from a stream go through :func:`creditpath.streaming.ingest.jdbc_batch_writer`,
where a retried micro-batch replaces its own table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import default_partitions


def jdbc_properties(user: str | None = None, password: str | None = None,
                    driver: str | None = None, **extra: str) -> dict[str, str]:
    props = {k: v for k, v in {"user": user, "password": password, "driver": driver}.items() if v}
    props.update(extra)
    return props


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Batch read; with a numeric, date or timestamp column and its range, over that many connections."""
    if partition_column is None:
        return spark.read.jdbc(url=url, table=table, properties=properties)
    return spark.read.jdbc(
        url=url, table=table, properties=properties, column=partition_column,
        lowerBound=lower, upperBound=upper, numPartitions=num_partitions or default_partitions(spark),
    )


def _quoted(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_jdbc_table(
    spark: SparkSession, name: str, url: str, dbtable: str, properties: dict[str, str]
) -> DataFrame:
    """``CREATE TABLE name USING jdbc OPTIONS (...)`` (schema taken from the database).

    The catalog stores these options; pass credentials through a driver's own
    mechanism where others may read the catalog.
    """
    opts = {"url": url, "dbtable": dbtable, **properties}
    rendered = ", ".join(f"{k} {_quoted(v)}" for k, v in opts.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING jdbc OPTIONS ({rendered})")
    return spark.table(name)
