"""Streaming ingest of raw touch files into bronze.

``readStream`` of lines -> in each micro-batch the values by their file's own
header and the same typing projection as batch reads -> ``foreachBatch`` sink.
A micro-batch holds whole files, so their headers are among its lines. Every micro-batch is written under its batch id and
replaces what an earlier attempt of that batch has left, so that a batch that
failed half-way is written whole when it is retried; together with the
checkpoint this gives each row once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import shared_dir
from ..functions.typing import type_touch_columns
from ..sources.catalog import VERSION, VersionLog
from ..sources.files import CORRUPT, SOURCE_FILE, read_touch_csv, text_lines, touches_by_header

BATCH_ID = "batch_id"


def touch_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the lines of all CSV files in a folder, each with its file."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return text_lines(reader.load(path))


def _parted(batch: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    if CORRUPT not in batch.columns:
        return batch, None
    good = batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT, SOURCE_FILE)
    return good, batch.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, SOURCE_FILE)


def parquet_batch_writer(path: str, quarantine: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: batch ``k`` goes to ``path/batch_id=k`` (overwrite).

    Lines that don't fit their file's header go to ``quarantine/batch_id=k``, with the file's name.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = _parted(batch)
        good.write.mode("overwrite").parquet(f"{path}/{BATCH_ID}={batch_id}")
        if quarantine and bad is not None:
            bad.write.mode("overwrite").parquet(f"{quarantine}/{BATCH_ID}={batch_id}")

    return write


def committed_batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: batch ``k`` is staged in a folder of its own, then committed as entry ``k + 1`` of a log.

    Its good rows and its quarantined lines become visible together, and only
    whole, to :func:`read_committed`. An attempt that fails leaves nothing
    visible; a batch that is replayed after its commit is not written again.
    A path belongs to one stream checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        log = VersionLog(batch.sparkSession, path)
        if log.has(batch_id + 1):
            return
        staged = f"{path.rstrip('/')}{VERSION}batch-{batch_id}-{uuid.uuid4().hex[:12]}"
        good, bad = _parted(batch)
        good.write.parquet(f"{staged}/data")
        if bad is not None:
            bad.write.parquet(f"{staged}/quarantine")
        if not log.commit(batch_id + 1, staged):  # another attempt was first
            log.fs.delete(log._path(staged), True)

    return write


def read_committed(spark: SparkSession, path: str, schema: StructType, part: str = "data") -> DataFrame:
    """Rows of all batches committed so far; ``part`` is ``data`` or ``quarantine`` (of rows in the given schema)."""
    folders = [f"{folder}/{part}" for folder in VersionLog(spark, path).folders()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def jdbc_batch_writer(url: str, table: str, properties: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: batch ``k`` goes to a table of its own, ``<table>_batch_k``, overwritten.

    A JDBC write commits task by task, so an attempt may leave a part of its
    rows. The retry replaces the batch's table whole; no row is lost or
    doubled, and no error is taken for a missing table. Readers take all batch
    tables together, e.g. through a view.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        good, _ = _parted(batch)
        good.withColumn(BATCH_ID, F.lit(batch_id).cast("long")).write.jdbc(
            url=url, table=f"{table}_batch_{batch_id}", mode="overwrite", properties=properties
        )

    return write


def start_ingest(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = True,
    time_format: str | None = None,
    mapping: dict[str, str] | None = None,
    separator: str = ",",
) -> StreamingQuery:
    """Starts the stream of :func:`touch_file_stream`; ``write_batch`` gets typed touches."""

    def write(lines: DataFrame, batch_id: int) -> None:
        touches = touches_by_header(lines, mapping, separator)
        write_batch(type_touch_columns(touches, fmt=time_format) if time_format else type_touch_columns(touches), batch_id)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def finish(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Waits for a run-once stream; raises if it fails, or is stopped for taking too long."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError("the stream did not finish in time; what it has written is not complete")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


# Text format used when touches are written out for the stream.
STREAM_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def roundtrip_through_stream(
    spark: SparkSession, touches: DataFrame, timeout_s: float = 600, six_columns: bool = False
) -> DataFrame:
    """Write ``touches`` as CSV files, ingest them with the stream, read bronze back.

    Used to check that the streaming path yields exactly the batch rows.
    ``six_columns`` writes the wider raw layout, in its own column order.
    """
    base = shared_dir(spark, "stream")
    write_layouts(touches, f"{base}/raw", LAYOUTS[1:2] if six_columns else LAYOUTS[:1])
    return ingest_folder(spark, f"{base}/raw", base, timeout_s)


def ingest_folder(spark: SparkSession, raw: str, base: str, timeout_s: float = 600) -> DataFrame:
    """One run of the stream over ``raw`` into ``base``; bronze read back."""
    q = start_ingest(touch_file_stream(spark, raw), parquet_batch_writer(f"{base}/bronze"), f"{base}/checkpoint",
                     time_format=STREAM_TIME_FORMAT)
    finish(q, timeout_s)
    return _plain(spark.read.parquet(f"{base}/bronze"))


def _plain(touches: DataFrame) -> DataFrame:
    return touches.select("uid", "channel", F.col("time").cast("timestamp_ntz").alias("time"), "conversion")


#: Column orders and names of raw files, as they are met in one folder.
LAYOUTS = [
    ["uid", "channel", "time", "conversion"],
    ["time", "conversion", "ad_id", "user_id", "revenue", "event_type"],
    ["channel", "uid", "conversion", "time"],
    ["conversion", "note", "time", "uid", "channel"],
]


def write_layouts(touches: DataFrame, folder: str, layouts: list[list[str]]) -> None:
    """Touches as CSV files, dealt out by a hash over files of the given layouts, all in one folder."""
    source = {
        "time": F.date_format("time", STREAM_TIME_FORMAT), "conversion": F.col("conversion").cast("string"),
        "uid": F.col("uid"), "channel": F.col("channel"), "user_id": F.col("uid"), "event_type": F.col("channel"),
        "ad_id": F.lit("ad"), "revenue": F.lit("0.5"), "note": F.lit('said "yes", twice'),
    }
    dealt = touches.withColumn("_layout", F.pmod(F.xxhash64("uid", "time"), F.lit(len(layouts))))
    for k, names in enumerate(layouts):
        rows = dealt.where(F.col("_layout") == k)
        rows.select(*[source[n].alias(n) for n in names]).write.mode("append").option("header", True).csv(folder)


def layouts_roundtrip(spark: SparkSession, touches: DataFrame, streamed: bool) -> DataFrame:
    """Touches written as files of all LAYOUTS and read back by their headers, as a batch or as a stream."""
    base = shared_dir(spark, "layouts")
    write_layouts(touches, f"{base}/raw", LAYOUTS)
    if streamed:
        return ingest_folder(spark, f"{base}/raw", base)
    back = read_touch_csv(spark, f"{base}/raw", fmt=STREAM_TIME_FORMAT)
    return _plain(back.where(F.col(CORRUPT).isNull()))
