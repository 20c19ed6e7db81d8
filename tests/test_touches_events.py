"""FIXTURES F2: touches and journeys derived from the driver's events table."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from creditpath.plans.attribution import AttributionPlan

EXPECTED = {
    SF0001: dict(touches=798, conv=94, journeys=369, converting=51, longest=7,
                 paths=103, transitions=1167, edges=28),
    SF001: dict(touches=8019, conv=967, journeys=3720, converting=544, longest=8,
                paths=416, transitions=11739, edges=28),
}


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_counts(spark, sf):
    e = EXPECTED[sf]
    p = AttributionPlan.from_events(spark, sf)
    t = p.touches
    assert t.count() == e["touches"]
    assert t.where("conversion = 1").count() == e["conv"]
    j = p.journeys
    assert j.count() == e["journeys"]
    assert j.where("conversion = 1").count() == e["converting"]
    assert j.agg(F.max("n_touches")).first()[0] == e["longest"]
    assert p.edges.count() == e["transitions"] == e["touches"] + e["journeys"]
    assert p.transition_counts.count() == e["edges"]
    uj = p.user_journey
    assert uj.count() == e["touches"] and uj.select("uid").distinct().count() == e["journeys"]
    paths = uj.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("seq", "channel"))).alias("p"))
    assert paths.select(F.transform("p", lambda x: x["channel"])).distinct().count() == e["paths"]
    assert p.rejected.count() == 0


def test_touch_shares_sf001(spark):
    p = AttributionPlan.from_events(spark, SF001)
    ft = {r.channel: r.attribution_percent for r in p.first_touch.collect()}
    lt = {r.channel: r.attribution_percent for r in p.last_touch.collect()}
    assert ft["click"] == pytest.approx(0.262868, abs=1e-6)
    assert ft["view"] == pytest.approx(0.222426, abs=1e-6)
    assert lt["error"] == pytest.approx(0.257353, abs=1e-6)
    assert lt["click"] == pytest.approx(0.25, abs=1e-6)


@pytest.mark.parametrize(
    "policy,baseline,no_click",
    [("absorbing", 0.146237, 0.084669), ("simple_path", 0.103306, 0.066345),
     ("memo_walk", 0.082823, 0.058318)],
)
def test_conversion_probability_sf001(spark, policy, baseline, no_click):
    p = AttributionPlan.from_events(spark, SF001)
    got = {r.removed_channel: r.conversion_probability
           for r in p.conversion_probability(policy).collect()}
    assert got[None] == pytest.approx(baseline, abs=1e-6)
    assert got["click"] == pytest.approx(no_click, abs=1e-6)


def test_invariants_sf001(spark):
    p = AttributionPlan.from_events(spark, SF001)
    # rows sum to one
    assert all(r.transition_probability_sum == 1.0 for r in p.row_sums.collect())
    # absorbing baseline = conversion rate of journeys
    j = p.journeys
    rate = j.where("conversion = 1").count() / j.count()
    ab = {r.removed_channel: r.conversion_probability
          for r in p.conversion_probability("absorbing").collect()}
    assert ab[None] == pytest.approx(rate, abs=1e-12)
    sp = {r.removed_channel: r.conversion_probability
          for r in p.conversion_probability("simple_path").collect()}
    assert all(sp[k] <= ab[k] + 1e-12 for k in ab)
    # E1 == F1 + F2
    a = {(r.start_state + " > " + r.end_state, r.total_transitions)
         for r in p.transition_counts.collect()}
    b = {(r.transition, r["count"]) for r in p.path_transitions.groupBy("transition").count().collect()}
    assert a == b


def test_absorbing_by_panels_gives_the_same(spark, monkeypatch):
    from creditpath.operators import absorbing as A
    from creditpath.operators import markov as M

    matrix = AttributionPlan.from_events(spark, SF0001).matrix.checkpoint()
    a = {r.removed_channel: r.conversion_probability for r in M.absorbing_probability(matrix).collect()}
    monkeypatch.setattr(A, "LOCAL_STATES", 2)
    monkeypatch.setattr(A, "PANEL", 1)
    b = {r.removed_channel: r.conversion_probability for r in M.absorbing_probability(matrix).collect()}
    assert set(a) == set(b)
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-12)


def test_memo_walk_refuses_more_edges_than_may_travel(spark, monkeypatch):
    from creditpath.operators import markov as M

    monkeypatch.setattr(M, "MAX_EDGES", 3)
    with pytest.raises(ValueError):
        M.memo_walk_probability(AttributionPlan.from_events(spark, SF0001).matrix)


def test_many_channels_on_sparse_edges(spark):
    """2,000 channels, each followed by the next two; the closed form of a chain is known."""
    from creditpath.operators import markov as M

    n = 2_000
    rows = [("Start", "c0", 1.0)]
    for i in range(n):
        after = [f"c{i + 1}" if i + 1 < n else "Conversion", "Null", f"c{i}"]
        rows += [(f"c{i}", s, p) for s, p in zip(after, (0.9985, 0.0005, 0.001))]
    matrix = spark.createDataFrame(rows, "start_state string, end_state string, transition_probability double")
    got = {r.removed_channel: r.conversion_probability for r in M.absorbing_probability(matrix).collect()}
    assert len(got) == n + 1
    assert got[None] == pytest.approx((0.9985 / 0.999) ** n, rel=1e-9)
    assert all(v == 0.0 for k, v in got.items() if k is not None)


def test_memo_walk_on_a_long_chain(spark):
    from creditpath.operators import markov as M

    n = 1_500
    rows = [("Start", "c0", 1.0)] + [(f"c{i}", f"c{i + 1}" if i + 1 < n else "Conversion", 1.0) for i in range(n)]
    matrix = spark.createDataFrame(rows, "start_state string, end_state string, transition_probability double")
    got = {r.removed_channel: r.conversion_probability for r in M.memo_walk_probability(matrix).collect()}
    assert got[None] == 1.0 and got["c700"] == 0.0


@pytest.mark.parametrize("sf,desc,asc", [(SF0001, 0.078846, 0.078409), (SF001, 0.082823, 0.082540)])
def test_memo_walk_depends_on_next_state_order(spark, sf, desc, asc):
    from creditpath.operators import markov as M

    g = AttributionPlan.from_events(spark, sf).matrix
    d = {r.removed_channel: r.conversion_probability
         for r in M.memo_walk_probability(g, descending=True).collect()}
    a = {r.removed_channel: r.conversion_probability
         for r in M.memo_walk_probability(g, descending=False).collect()}
    assert d[None] == pytest.approx(desc, abs=1e-6)
    assert a[None] == pytest.approx(asc, abs=1e-6)


def test_null_users_and_channels_are_rejected(spark):
    from creditpath.sources.events import touches_from_events

    rows = [
        (1, "2024-01-01 10:00:00", None, "view"), (2, "2024-01-01 11:00:00", None, "purchase"),
        (3, "2024-01-01 10:00:00", 7, " view "), (4, "2024-01-01 11:00:00", 7, None),
        (5, "2024-01-01 12:00:00", 7, "view"), (6, "2024-01-01 13:00:00", 7, "purchase"),
        (7, "2024-01-01 10:00:00", 8, " Null "), (8, "2024-01-01 11:00:00", 8, "a > b"), (9, "2024-01-01 12:00:00", 8, "  "),
    ]
    ev = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string").withColumn("ts", F.to_timestamp("ts"))
    p = AttributionPlan(touches_from_events(ev))
    assert {r.event_id: r.reject_reason for r in p.rejected.collect()} == {
        1: "missing uid", 4: "missing channel", 7: "reserved channel name", 8: "separator in channel name", 9: "missing channel",
    }
    edges = sorted((r.start_state, r.end_state) for r in p.edges.collect())
    assert edges == [("Start", "view"), ("view", "Conversion"), ("view", "view")]
    assert sorted(r.transition for r in p.path_transitions.collect()) == ["Start > view", "view > Conversion", "view > view"]
    assert {r.conversion for r in p.rejected.where("event_id = 1").collect()} == {0}


def test_hot_journey_is_one_row_per_touch(spark):
    """A uid with half of all touches: as many rows as touches, dealt over the files that cluster them."""
    from creditpath.sources import catalog as C

    touches = spark.range(6_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id"))).alias("uid"),
        F.concat(F.lit("c"), F.col("id") % 3).alias("channel"),
        F.timestamp_seconds(F.col("id") * 60).alias("time"),
        F.lit(0).alias("conversion"),
        F.col("id").alias("event_id"),
    )
    uj = AttributionPlan(touches, num_partitions=8).user_journey
    hot = uj.where("uid = 'hot'").orderBy("seq").collect()
    assert [r.seq for r in hot] == list(range(1, 3_001)) and [r.visit_order for r in hot] == [r.seq for r in hot]
    assert hot[1].previous_channel == hot[0].channel and hot[0].previous_channel is None
    files = C.clustered(uj, ["uid", "seq"], 8).withColumn("p", F.spark_partition_id())
    assert files.where("uid = 'hot'").select("p").distinct().count() >= 4


def test_plans_keep_nothing(spark):
    p = AttributionPlan.from_events(spark, SF0001)
    for df in (p.journeys, p.user_journey, p.matrix, p.removal_graph("click")):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert "InMemoryRelation" not in text and "MapIn" not in text
    # of one scenario's graph no stage is a single task
    assert "SinglePartition" not in p.removal_graph("click")._jdf.queryExecution().executedPlan().toString()
