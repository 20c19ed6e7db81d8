"""The skew-safe ordered scan equals lag/lead/row_number/dense_rank windows."""


import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF0001
from creditpath.operators.sequence import bucket_of, cut_points, hot_groups, is_hot, ordered_scan


def _reference(df, group, order, carry, rank_value):
    w = Window.partitionBy(*group).orderBy(*order)
    wr = Window.partitionBy(*group).orderBy(rank_value)
    cols = [F.col(c) for c in df.columns]
    for c in carry:
        cols.append(F.lag(c).over(w).alias(f"prev_{c}"))
    for c in carry:
        cols.append(F.lead(c).over(w).alias(f"next_{c}"))
    cols.append(F.row_number().over(w).cast("long").alias("seq"))
    cols.append(F.dense_rank().over(wr).cast("long").alias("dr"))
    return df.select(*cols)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("nparts", [1, 3, 17, 64])
def test_hot_groups_span_partitions(spark, nparts):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    # five groups only: every group spans many range partitions
    out = ordered_scan(ev, ["event_type"], ["ts", "event_id"], ["event_id", "value"],
                       seq_col="seq", dense_rank_col="dr", rank_value="ts", num_partitions=nparts)
    ref = _reference(ev, ["event_type"], ["ts", "event_id"], ["event_id", "value"], "ts")
    assert _same(out.select(ref.columns), ref)


def test_ties_share_dense_rank(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn(
        "day", F.to_date("ts"))
    out = ordered_scan(ev, ["event_type"], ["day", "event_id"], [], seq_col="seq",
                       dense_rank_col="dr", rank_value="day", num_partitions=23)
    ref = _reference(ev, ["event_type"], ["day", "event_id"], [], "day")
    assert _same(out.select(ref.columns), ref)


def test_neighbours_only_many_partitions(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    out = ordered_scan(ev, ["user_id"], ["ts", "event_id"], ["event_type"], num_partitions=50)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = ev.select("*", F.lag("event_type").over(w).alias("prev_event_type"),
                    F.lead("event_type").over(w).alias("next_event_type"))
    assert _same(out.select(ref.columns), ref)


@settings(max_examples=15, deadline=None)
@given(
    rows=st.lists(
        st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 6),
                  st.sampled_from(["x", "y", None])),
        min_size=0, max_size=60),
    nparts=st.integers(1, 9),
)
def test_random_against_pandas(spark, rows, nparts):
    data = [(g, t, v, i) for i, (g, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, t int, v string, id long")
    out = ordered_scan(df, ["g"], ["t", "id"], ["v"], seq_col="seq", dense_rank_col="dr",
                       rank_value="t", num_partitions=nparts).toPandas()
    pdf = pd.DataFrame(data, columns=["g", "t", "v", "id"])
    exp = {}
    for g, part in pdf.assign(gk=pdf["g"].fillna("\0")).groupby("gk", sort=False):
        part = part.sort_values(["t", "id"])
        vals, ids, ts = list(part["v"]), list(part["id"]), list(part["t"])
        ranks = {t: i + 1 for i, t in enumerate(sorted(set(ts)))}
        for k, i in enumerate(ids):
            exp[i] = (vals[k - 1] if k else None, vals[k + 1] if k + 1 < len(ids) else None,
                      k + 1, ranks[ts[k]])
    got = {r.id: (r.prev_v, r.next_v, r.seq, r.dr) for r in out.itertuples()}
    norm = lambda x: None if x is None or (isinstance(x, float) and x != x) else x
    got = {k: tuple(norm(x) for x in v) for k, v in got.items()}
    exp = {k: tuple(norm(x) for x in v) for k, v in exp.items()}
    assert got == exp


@pytest.mark.parametrize("nparts", [1, 7, 40])
def test_last_valid_matches_window(spark, nparts):
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn(
        "touch", F.when(F.col("event_type") != "purchase", F.col("event_type")))
    # hot groups (5 event types would be trivial); use 3 coarse groups
    ev = ev.withColumn("g", (F.col("user_id") % 3).cast("string"))
    out = ordered_scan(ev, ["g"], ["ts", "event_id"], ["event_type"], last_valid=["touch"],
                       num_partitions=nparts)
    w = Window.partitionBy("g").orderBy("ts", "event_id")
    ref = ev.select(
        "*", F.lag("event_type").over(w).alias("prev_event_type"),
        F.lead("event_type").over(w).alias("next_event_type"),
        F.last("touch", ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)).alias("prev_touch"))
    assert _same(out.select(ref.columns), ref)


@settings(max_examples=15, deadline=None)
@given(
    rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["x", "y", None, None])),
                  min_size=0, max_size=50),
    nparts=st.integers(1, 12),
)
def test_last_valid_random(spark, rows, nparts):
    data = [(g, v, i) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, v string, id long")
    got = {r.id: r.prev_v for r in ordered_scan(
        df, ["g"], ["id"], [], last_valid=["v"], num_partitions=nparts).collect()}
    exp, last = {}, {}
    for g, v, i in data:
        exp[i] = last.get(g)
        if v is not None:
            last[g] = v
    assert got == exp


def test_hot_key_is_split_and_exact(spark):
    """A uid holding a third of all rows is spread over many partitions, results unchanged."""

    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    hot = ev.withColumn(
        "uid", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(
            F.col("user_id").cast("string")))
    n = 12
    out = ordered_scan(hot, ["uid"], ["ts", "event_id"], ["event_type"], seq_col="seq",
                       num_partitions=n)
    w = Window.partitionBy("uid").orderBy("ts", "event_id")
    ref = hot.select("*", F.lag("event_type").over(w).alias("prev_event_type"),
                     F.lead("event_type").over(w).alias("next_event_type"),
                     F.row_number().over(w).cast("long").alias("seq"))
    assert _same(out.select(ref.columns), ref)
    # the windows' keys: (uid, bucket) spreads the hot rows about evenly
    hashes, held, total = hot_groups(hot, ["uid"], n)
    mine = hot.where(is_hot(["uid"], hashes))
    assert total == hot.count() and held == mine.count() and [r.uid for r in mine.select("uid").distinct().collect()] == ["hot"]
    bounds = cut_points(mine, ["ts", "event_id"], n, held)
    sizes = [r["count"] for r in mine.groupBy(bucket_of(F.struct("ts", "event_id"), bounds)).count().collect()]
    assert len(sizes) == n
    assert max(sizes) <= 2 * sum(sizes) / n


def test_hot_group_of_one_timestamp_is_dealt_out(spark):
    """Half of the rows are one group's, all at one time: they are cut by the event id; ranks stay shared."""
    ev = spark.read.parquet(f"{SF0001}/events.parquet").where("event_id % 7 > 0")
    same = F.to_timestamp(F.lit("2024-01-05 10:00:00")).cast("timestamp_ntz")
    tied = ev.select(
        F.when(F.col("event_id") % 2 == 0, "hot").otherwise(F.col("user_id").cast("string")).alias("uid"),
        F.when(F.col("event_id") % 2 == 0, same).otherwise(F.col("ts")).alias("ts"), "event_id", "event_type",
    )
    hashes, held, _ = hot_groups(tied, ["uid"], 16)
    bounds = cut_points(tied.where(is_hot(["uid"], hashes)), ["ts", "event_id"], 8, held)
    sizes = [r["count"] for r in tied.where("uid = 'hot'").groupBy(bucket_of(F.struct("ts", "event_id"), bounds)).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / 8
    out = ordered_scan(tied, ["uid"], ["ts", "event_id"], ["event_type"], seq_col="seq", dense_rank_col="dr",
                       rank_value="ts", num_partitions=16)
    ref = _reference(tied, ["uid"], ["ts", "event_id"], ["event_type"], "ts")
    assert _same(out.select(ref.columns), ref)


@pytest.mark.parametrize("kind", ["binary", "date", "double", "decimal(12,3)", "timestamp"])
def test_cut_points_of_every_type(spark, kind):
    df = spark.range(2000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("n"), "id")
    value = {"binary": F.col("n").cast("string").cast("binary"), "date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("n").cast("int")),
             "timestamp": F.timestamp_seconds(F.col("n") * 3600)}.get(kind, (F.col("n") / 8).cast(kind))
    df = df.withColumn("t", value).drop("n")
    out = ordered_scan(df, ["g"], ["t", "id"], ["id"], seq_col="seq", dense_rank_col="dr", rank_value="t", num_partitions=6)
    ref = _reference(df, ["g"], ["t", "id"], ["id"], "t")
    assert _same(out.select(ref.columns), ref)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan  # both groups are hot


def test_cold_groups_run_one_plain_window(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    out = ordered_scan(ev, ["user_id"], ["ts", "event_id"], ["event_type"], seq_col="seq", num_partitions=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_plan_shuffles_rows_once_and_keeps_nothing(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    out = ordered_scan(ev, ["user_id"], ["ts", "event_id"], ["event_type"], seq_col="seq")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "MapInArrow" not in plan and "MapInPandas" not in plan


def test_default_partitioning_with_coalescing(spark):
    """No explicit count: AQE may merge neighbouring range partitions; results unchanged."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        ev = spark.read.parquet(f"{SF0001}/events.parquet")
        out = ordered_scan(ev, ["event_type"], ["ts", "event_id"], ["event_id"], seq_col="seq",
                           dense_rank_col="dr", rank_value="ts")
        ref = _reference(ev, ["event_type"], ["ts", "event_id"], ["event_id"], "ts")
        assert _same(out.select(ref.columns), ref)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
