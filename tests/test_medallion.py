"""raw CSV -> bronze (stream) -> gold tables, and a second run that leaves gold intact."""

from pyspark.sql import functions as F

from conftest import SF0001
from creditpath.config import TableLayout, shared_dir
from creditpath.plans import medallion as MD
from creditpath.plans.attribution import AttributionPlan


def test_raw_to_gold(spark):
    base = shared_dir(spark, "medallion")
    touches = AttributionPlan.from_events(spark, SF0001).touches
    touches.select("uid", "channel", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"),
                   F.col("conversion").cast("string").alias("conversion")) \
        .write.option("header", True).csv(f"{base}/raw")
    layout = TableLayout(database="cp_gold", raw_path=f"{base}/raw", bronze_path=f"{base}/bronze",
                         gold_user_journey_path=f"{base}/gj", gold_attribution_path=f"{base}/ga")
    bronze = MD.ingest(spark, layout, timeout_s=300)
    assert bronze.count() == touches.count()
    gold = MD.build_gold(spark, layout, bronze)
    ga = gold["gold_attribution"]
    models = {r.attribution_model for r in ga.collect()}
    assert models == {"first_touch", "last_touch", "markov_chain"}
    assert gold["gold_user_journey"].count() == touches.count()
    # a second run upserts again: same keys, no duplicates
    gold2 = MD.build_gold(spark, layout, bronze)
    assert gold2["gold_attribution"].count() == ga.count()
    spark.catalog.setCurrentDatabase("default")


def _layout(base, db):
    return TableLayout(database=db, raw_path=f"{base}/raw", bronze_path=f"{base}/bronze",
                       gold_user_journey_path=f"{base}/gj", gold_attribution_path=f"{base}/ga")


def _touches(spark, channels):
    rows = [(f"u{i}", c, f"2024-01-01 10:00:{i:02d}", i % 2) for i, c in enumerate(channels * 3)]
    return spark.createDataFrame(rows, "uid string, channel string, t string, conversion int").select(
        "uid", "channel", F.to_timestamp("t").alias("time"), "conversion")


def test_second_run_replaces_all_models_in_place(spark):
    layout = _layout(shared_dir(spark, "medallion"), "cp_gold2")
    MD.build_gold(spark, layout, _touches(spark, ["B", "D", "X"]))
    for channels in (["X", "Y", "Z", "W", "Q"], ["X", "Y", "W"]):
        gold = MD.build_gold(spark, layout, _touches(spark, channels))["gold_attribution"]
        for model in ("first_touch", "last_touch", "markov_chain"):
            assert {r.channel for r in gold.where(F.col("attribution_model") == model).collect()} <= set(channels)
    from creditpath.sources.catalog import table_location

    assert layout.gold_attribution_path.split(":")[-1] in table_location(spark, "cp_gold2.gold_attribution")


def test_timeout_raises(spark):
    import pytest

    base = shared_dir(spark, "medallion")
    _touches(spark, ["A"]).select("uid", "channel", F.col("time").cast("string"), F.col("conversion").cast("string")) \
        .repartition(40).write.option("header", True).csv(f"{base}/raw")
    with pytest.raises(TimeoutError):
        MD.ingest(spark, _layout(base, "x"), timeout_s=0.001)


def test_six_column_files_and_quarantine(spark):
    base = shared_dir(spark, "medallion")
    import os

    folder = f"{base}/raw".removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w") as f:
        f.write("time,conversion,ad_id,user_id,revenue,event_type\n")
        f.write("2024-01-01 10:00:00,1,ad1,42,9.5,Email\n")
        f.write("2024-01-01 11:00:00,0,ad1,43,9.5,Social,one,too,many\n")
    layout = _layout(base, "x")
    rows = MD.ingest(spark, layout).collect()
    assert [(r.uid, r.channel, str(r.time), r.conversion) for r in rows] == [("42", "Email", "2024-01-01 10:00:00", 1)]
    bad = spark.read.parquet(f"{layout.bronze_path}/quarantine").collect()
    assert len(bad) == 1 and "too,many" in bad[0]["_corrupt_record"]


def test_unknown_header_is_refused(spark):
    import os

    import pytest

    base = shared_dir(spark, "medallion")
    folder = f"{base}/raw".removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w") as f:
        f.write("when,who\n1,2\n")
    with pytest.raises(ValueError, match="no columns"):
        MD.ingest(spark, _layout(base, "x"))
