"""Stream ingest equals the batch rows; a restart on the same checkpoint adds nothing."""

from pyspark.sql import functions as F

from conftest import SF0001
from creditpath.config import shared_dir
from creditpath.plans.attribution import AttributionPlan
from creditpath.streaming import ingest as S


def test_stream_equals_batch(spark):
    touches = AttributionPlan.from_events(spark, SF0001).touches.select(
        "uid", "channel", "time", "conversion")
    out = S.roundtrip_through_stream(spark, touches)
    assert out.exceptAll(touches).count() == 0 and touches.exceptAll(out).count() == 0


def test_restart_adds_no_rows(spark):
    touches = AttributionPlan.from_events(spark, SF0001).touches.select(
        "uid", "channel", F.date_format("time", S.STREAM_TIME_FORMAT).alias("time"),
        F.col("conversion").cast("string").alias("conversion"))
    base = shared_dir(spark, "restart")
    raw, bronze, ckpt = f"{base}/raw", f"{base}/bronze", f"{base}/ckpt"
    touches.write.option("header", True).csv(raw)
    for _ in range(2):
        q = S.start_ingest(S.touch_file_stream(spark, raw, max_files_per_trigger=2),
                           S.parquet_batch_writer(bronze), ckpt, time_format=S.STREAM_TIME_FORMAT)
        q.awaitTermination(300)
    assert spark.read.parquet(bronze).count() == touches.count()
