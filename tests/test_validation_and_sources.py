"""FIXTURES F3: dirty CSV touches, typing never fails, V1 quarantine."""

import os
import tempfile

from creditpath.operators.validate import split_valid
from creditpath.sources.files import header_schema, read_touch_csv
from creditpath.functions.paths import transition_array

DIRTY = """uid,channel,time,conversion
u1,Email,2024-01-01 10:00:00,1
u2,Email,not a time,0
u3,Email,2024-01-01 10:00:00,yes
u4,,2024-01-01 10:00:00,0
u5,Null,2024-01-01 10:00:00,0
u6,A>B,2024-01-01 10:00:00,0
,Email,2024-01-01 10:00:00,0
u7,Email,2024-01-01 10:00:00,0
u7,Social,2024-01-01 10:00:00,1
"""


def _csv():
    d = tempfile.mkdtemp(prefix="dirty-")
    with open(os.path.join(d, "touches.csv"), "w") as f:
        f.write(DIRTY)
    return d


def test_typing_and_quarantine(spark):
    path = _csv()
    schema = header_schema(spark, path)
    assert [f.name for f in schema.fields] == ["uid", "channel", "time", "conversion"]
    df = read_touch_csv(spark, path)
    rows = {(r.uid, r.channel): r for r in df.collect()}
    assert rows[("u2", "Email")].time is None
    assert rows[("u3", "Email")].conversion is None
    good, bad = split_valid(df)
    reasons = {r.uid: r.reject_reason for r in bad.collect()}
    assert reasons == {
        "u2": "missing time", "u4": "missing channel", "u5": "reserved channel name",
        "u6": "separator in channel name", None: "missing uid",
    }
    assert sorted(r.uid for r in good.collect()) == ["u1", "u3", "u7", "u7"]


def test_equal_times_share_visit_order(spark):
    from creditpath.plans.attribution import AttributionPlan

    df = read_touch_csv(spark, _csv())
    p = AttributionPlan(df)
    v = {(r.uid, r.channel): r.visit_order for r in p.visit_order.collect()}
    assert v[("u7", "Email")] == v[("u7", "Social")] == 1
    # u3 has a NULL conversion flag: its journey takes the last non-NULL flag (none)
    j = {r.uid: r.conversion for r in p.journeys.collect()}
    assert j["u3"] is None and j["u7"] == 1


def test_transition_array_edges(spark):
    df = spark.createDataFrame(
        [("Start > a > a > Conversion",), ("Start > Null",), (None,)], "path string")
    got = [r.t for r in df.select(transition_array("path").alias("t")).collect()]
    assert got[0] == ["Start > a", "a > a", "a > Conversion"]
    assert got[1] == ["Start > Null"]
    assert got[2] is None


def test_bronze_mapping(spark):
    from creditpath.schemas import INGEST_SCHEMA
    from creditpath.sources.files import touches_from_bronze
    import datetime as dt

    bronze = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10), 1, "ad1", "42", 9.5, "Email")], INGEST_SCHEMA)
    t = touches_from_bronze(bronze)
    assert t.columns == ["uid", "channel", "time", "conversion"]
    r = t.first()
    assert (r.uid, r.channel, r.conversion) == ("42", "Email", 1)
    assert r.time == dt.datetime(2024, 1, 1, 10)
