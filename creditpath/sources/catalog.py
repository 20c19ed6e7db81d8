"""Catalog and table sinks: databases, save-once tables, upsert, clustered writes.

Parquet tables have no MERGE. :func:`upsert` therefore computes the merged
rows with a full outer join (source wins), writes them to a *new* folder below
the table's own location, and commits that folder in a log beside it: entry
``k + 1`` is made by a rename that fails if the entry is there, so of several
writers that started from version ``k`` one commits, and the others merge again
into the version they then find. The catalog is pointed at the last committed
version with ``ALTER TABLE ... SET LOCATION``. Readers never see a half-written
table; versions that they may still read stay for a retention time. Catalogs
that support ``MERGE INTO`` (Delta, Iceberg) can use ``DataFrame.mergeInto``
instead (``method="merge"``).
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import checkpoint_root, default_partitions, shared_dir


def create_database(spark: SparkSession, name: str, drop_first: bool = False) -> None:
    """``CREATE DATABASE IF NOT EXISTS``; dropping only when asked explicitly."""
    if drop_first:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def use_database(spark: SparkSession, name: str) -> bool:
    """Switch the current database; ``False`` (no exception) when it is missing."""
    try:
        spark.catalog.setCurrentDatabase(name)
        return True
    except AnalysisException:
        return False


def save_once(
    df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS ... LOCATION ... AS SELECT``.

    An existing table is left as it is (its data is not replaced).
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        writer = df.write.format(fmt)
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(table)
    return spark.table(table)


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")


def assert_unique_keys(source: DataFrame, keys: list[str]) -> None:
    """MERGE semantics: a target row may match at most one source row."""
    dup = source.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"upsert source has duplicate keys {keys}: {dup[0].asDict()}")


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows after ``WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *``."""
    cols = target.columns
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols]).withColumn("_t_hit", F.lit(True))
    s = source.select(*cols).select(*[F.col(c).alias(f"_s_{c}") for c in cols]).withColumn(
        "_s_hit", F.lit(True)
    )
    cond = None
    for k in keys:
        c = F.col(f"_t_{k}").eqNullSafe(F.col(f"_s_{k}"))
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    return j.select(
        *[
            F.when(F.col("_s_hit"), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c)
            for c in cols
        ]
    )


VERSION = "/_version-"


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


LOG = "_commits"
#: Seconds for which a version that was replaced, or never committed, stays.
RETENTION_S = 3600.0
#: Times that a merge is made anew because another writer was first.
MAX_RETRIES = 20


class VersionLog:
    """Committed versions of a table, below its root folder: numbered files that name a version's folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path(self.root).getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def latest(self) -> tuple[int, str | None]:
        """Number and folder of the last version; 0 and None before the first commit."""
        folder = self._path(f"{self.root}/{LOG}")
        if not self.fs.exists(folder):
            return 0, None
        numbers = [n for n in (x.getPath().getName() for x in self.fs.listStatus(folder)) if n.isdigit()]
        return (int(max(numbers)), self._read(max(numbers))) if numbers else (0, None)

    def has(self, number: int) -> bool:
        return self.fs.exists(self._path(f"{self.root}/{LOG}/{number:012}"))

    def folders(self) -> list[str]:
        """Folders of all entries, in their order."""
        log = self._path(f"{self.root}/{LOG}")
        names = [x.getPath().getName() for x in self.fs.listStatus(log)] if self.fs.exists(log) else []
        return [self._read(n) for n in sorted(names) if n.isdigit()]

    def _read(self, number: str) -> str:
        stream = self.fs.open(self._path(f"{self.root}/{LOG}/{number}"))
        try:
            return f"{self.root}/{self.jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
        finally:
            stream.close()

    def commit(self, number: int, version: str) -> bool:
        """Makes entry ``number``; False if another writer has made it."""
        draft = self._path(f"{self.root}/{LOG}/.{uuid.uuid4().hex}")
        out = self.fs.create(draft)
        out.write(bytearray(version.rpartition("/")[2].encode()))
        out.close()
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), self.conf)
        options = self.jvm.org.apache.hadoop.fs.Options
        rename = self.jvm.java.lang.reflect.Array.newInstance(options.Rename.NONE.getClass(), 1)
        rename[0] = options.Rename.NONE  # never over an entry that is there
        try:
            files.rename(self.fs.makeQualified(draft), self.fs.makeQualified(self._path(f"{self.root}/{LOG}/{number:012}")), rename)
            return True
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise

    def clean(self, keep: int, retention_s: float) -> None:
        """Removes folders of versions that no one of the last ``keep`` entries names and that are old enough."""
        last = self.latest()[0]
        named = {self._read(f"{n:012}") for n in range(max(1, last - keep + 1), last + 1)}
        before = (time.time() - retention_s) * 1000
        for status in self.fs.listStatus(self._path(self.root)):
            name = status.getPath().getName()
            if name.startswith(VERSION[1:]) and f"{self.root}/{name}" not in named and status.getModificationTime() <= before:
                self.fs.delete(status.getPath(), True)


def _publish(spark: SparkSession, table: str, log: VersionLog) -> None:
    """Points the catalog at the last version; again, if one was committed meanwhile."""
    while True:
        number, version = log.latest()
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        if log.latest()[0] == number:
            spark.catalog.refreshTable(table)
            return


def upsert(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: list[str],
    method: str = "rewrite",
    prune: list[str] | None = None,
    retention_s: float = RETENTION_S,
) -> DataFrame:
    """Update matching rows of ``table`` from ``source`` and insert the rest.

    ``prune`` names key columns: rows whose values there occur in the source,
    but which the source no longer has, are deleted (say, channels that a
    refreshed model doesn't name any more). Writers may run side by side: each
    one's rows are merged into what the one before has committed. The two last
    versions stay, others for ``retention_s`` seconds.
    """
    # The source is read by the key check and by the merge: keep it for both
    # (upsert sources here are attribution rows, a few per channel and model).
    checkpoint_root(spark)
    source = source.checkpoint()
    assert_unique_keys(source, keys)
    if method == "merge":
        cond = None
        for k in keys:
            c = F.col(f"{table}.{k}") == F.col(f"src.{k}")
            cond = c if cond is None else cond & c
        (
            source.alias("src")
            .mergeInto(table, cond)
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )
        return spark.table(table)
    root = table_location(spark, table).split(VERSION)[0]
    log = VersionLog(spark, root)
    columns = spark.table(table).columns
    for _ in range(MAX_RETRIES):
        number, version = log.latest()
        # the log, not the catalog, says what the last version is
        target = spark.read.parquet(version or root).select(*columns)
        if prune:
            target = target.join(source.select(*prune).distinct(), prune, "left_anti").select(*columns)
        new = f"{root}{VERSION}{uuid.uuid4().hex[:12]}"
        merge_rows(target, source, keys).write.mode("errorifexists").parquet(new)
        if log.commit(number + 1, new):
            _publish(spark, table, log)
            log.clean(2, retention_s)
            return spark.table(table)
    raise RuntimeError(f"other writers were first {MAX_RETRIES} times; nothing was changed in {table}")


def upsert_into_new_table(
    spark: SparkSession,
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    name: str,
    prune: list[str] | None = None,
) -> DataFrame:
    """Create a fresh table from ``target`` in shared storage, then upsert ``source``."""
    table = f"{name}_{shared_dir(spark, 'x').rsplit('-', 1)[-1]}"
    save_once(target, table, path=shared_dir(spark, table))
    return upsert(spark, table, source, keys, prune=prune)


def write_clustered(
    spark: SparkSession,
    df: DataFrame,
    keys: list[str],
    name: str,
    path: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Range-cluster by ``keys`` and write Parquet; read it back.

    Range partitioning gives every file a narrow, non-overlapping key range, so
    min/max statistics let later reads on the first key skip whole files. Name
    a further key that tells a frequent first key's rows apart, so that they
    are dealt over several files.
    """
    out = path or shared_dir(spark, name)
    clustered(df, keys, num_partitions).write.mode("errorifexists").parquet(out)
    return spark.read.parquet(out)


def clustered(df: DataFrame, keys: list[str], num_partitions: int | None = None) -> DataFrame:
    n = num_partitions or default_partitions(df.sparkSession)
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
