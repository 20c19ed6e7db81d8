"""FIXTURES F4 upsert, save-once tables, clustered writes."""

import pytest

from creditpath.sources import catalog as C

SCHEMA = "attribution_model string, channel string, attribution_percent double"


def test_upsert_update_insert_untouched(spark):
    target = spark.createDataFrame(
        [("first_touch", "Email", 0.10), ("last_touch", "Email", 0.20)], SCHEMA)
    source = spark.createDataFrame(
        [("first_touch", "Email", 0.30), ("markov_chain", "Email", 0.40)], SCHEMA)
    out = C.upsert_into_new_table(spark, target, source, ["attribution_model", "channel"], "gold_t")
    got = {(r.attribution_model, r.channel): r.attribution_percent for r in out.collect()}
    assert got == {("first_touch", "Email"): 0.30, ("last_touch", "Email"): 0.20,
                   ("markov_chain", "Email"): 0.40}


def test_upsert_duplicate_source_key_raises(spark):
    target = spark.createDataFrame([("first_touch", "Email", 0.10)], SCHEMA)
    source = spark.createDataFrame(
        [("first_touch", "Email", 0.30), ("first_touch", "Email", 0.31)], SCHEMA)
    with pytest.raises(ValueError):
        C.upsert_into_new_table(spark, target, source, ["attribution_model", "channel"], "gold_d")


def test_save_once_keeps_existing(spark, tmp_path):
    a = spark.createDataFrame([("m", "c", 1.0)], SCHEMA)
    b = spark.createDataFrame([("m", "c", 2.0)], SCHEMA)
    C.create_database(spark, "cp_test")
    assert C.use_database(spark, "cp_test")
    assert not C.use_database(spark, "cp_missing_db")
    C.save_once(a, "cp_test.once", path=str(tmp_path / "once"))
    out = C.save_once(b, "cp_test.once", path=str(tmp_path / "once"))
    assert [r.attribution_percent for r in out.collect()] == [1.0]
    assert C.describe(spark, "cp_test.once").count() >= 3
    spark.catalog.setCurrentDatabase("default")


def test_clustered_write_ranges(spark):
    df = spark.range(0, 1000).selectExpr("cast(id * 7919 % 1000 as string) as uid")
    out = C.write_clustered(spark, df, ["uid"], "clustered", num_partitions=4)
    assert out.count() == 1000
    # each file holds a contiguous, non-overlapping key range
    from pyspark.sql import functions as F
    ranges = (out.withColumn("f", F.input_file_name()).groupBy("f")
              .agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).orderBy("lo").collect())
    for a, b in zip(ranges, ranges[1:]):
        assert a.hi < b.lo


def test_versions_stay_below_the_table(spark, tmp_path):
    import os

    rows = spark.createDataFrame([("m", "a", 1.0), ("m", "b", 2.0), ("k", "z", 3.0)], SCHEMA)
    C.save_once(rows, "versioned_t", path=str(tmp_path / "t"))
    for k in range(4):
        more = spark.createDataFrame([("m", "a", 10.0 + k), ("m", f"n{k}", 0.0)], SCHEMA)
        C.upsert(spark, "versioned_t", more, ["attribution_model", "channel"], prune=["attribution_model"], retention_s=0)
    got = {(r.attribution_model, r.channel): r.attribution_percent for r in spark.table("versioned_t").collect()}
    assert got == {("m", "a"): 13.0, ("m", "n3"): 0.0, ("k", "z"): 3.0}
    versions = [d for d in os.listdir(tmp_path / "t") if d.startswith("_version-")]
    assert len(versions) == 2  # the current one and the one before
    assert str(tmp_path / "t") in C.table_location(spark, "versioned_t")


KEYS = ["attribution_model", "channel"]


def rows_of(spark, table):
    spark.catalog.refreshTable(table)
    return {(r.attribution_model, r.channel): r.attribution_percent for r in spark.table(table).collect()}


def test_second_writer_merges_into_what_the_first_committed(spark, tmp_path, monkeypatch):
    C.save_once(spark.createDataFrame([("m", "a", 1.0), ("m", "b", 2.0)], SCHEMA), "raced_t", path=str(tmp_path / "r"))
    mine = spark.createDataFrame([("m", "a", 10.0), ("m", "c", 3.0)], SCHEMA)
    theirs = spark.createDataFrame([("m", "b", 20.0), ("m", "d", 4.0)], SCHEMA)
    commit, calls = C.VersionLog.commit, []

    def late(self, number, version):
        calls.append(number)
        if len(calls) == 1:  # another writer commits between this one's merge and its commit
            C.upsert(spark, "raced_t", theirs, KEYS)
        return commit(self, number, version)

    monkeypatch.setattr(C.VersionLog, "commit", late)
    C.upsert(spark, "raced_t", mine, KEYS)
    assert calls == [1, 1, 2]
    assert rows_of(spark, "raced_t") == {("m", "a"): 10.0, ("m", "b"): 20.0, ("m", "c"): 3.0, ("m", "d"): 4.0}


def test_writers_side_by_side_lose_no_row(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    C.save_once(spark.createDataFrame([("m", "start", 0.0)], SCHEMA), "side_t", path=str(tmp_path / "s"))

    def write(k):
        C.upsert(spark, "side_t", spark.createDataFrame([("m", f"w{k}", float(k)), ("m", "start", 1.0)], SCHEMA), KEYS, retention_s=0)

    # a writer's folder is cleaned only when it is replaced or old; here those in the making must not be
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda k: C.upsert(spark, "side_t", spark.createDataFrame([("m", f"w{k}", float(k))], SCHEMA), KEYS), range(5)))
    write(9)
    assert rows_of(spark, "side_t") == {("m", "start"): 1.0, ("m", "w9"): 9.0, **{("m", f"w{k}"): float(k) for k in range(5)}}


def test_stale_catalog_entry_costs_no_rows(spark, tmp_path):
    """A catalog that points at an older version is put right by the next writer, which merges into the last one."""
    C.save_once(spark.createDataFrame([("m", "a", 1.0)], SCHEMA), "stale_t", path=str(tmp_path / "t"))
    C.upsert(spark, "stale_t", spark.createDataFrame([("m", "b", 2.0)], SCHEMA), KEYS)
    old = C.table_location(spark, "stale_t")
    C.upsert(spark, "stale_t", spark.createDataFrame([("m", "c", 3.0)], SCHEMA), KEYS)
    spark.sql(f"ALTER TABLE stale_t SET LOCATION '{old}'")
    C.upsert(spark, "stale_t", spark.createDataFrame([("m", "d", 4.0)], SCHEMA), KEYS)
    assert set(rows_of(spark, "stale_t")) == {("m", x) for x in "abcd"}


def test_failed_write_leaves_the_table(spark, tmp_path, monkeypatch):
    C.save_once(spark.createDataFrame([("m", "a", 1.0)], SCHEMA), "failed_t", path=str(tmp_path / "f"))

    def broken(*a):
        raise OSError("the folder is gone")

    monkeypatch.setattr(C.VersionLog, "commit", broken)
    with pytest.raises(OSError):
        C.upsert(spark, "failed_t", spark.createDataFrame([("m", "b", 2.0)], SCHEMA), KEYS)
    assert set(rows_of(spark, "failed_t")) == {("m", "a")}
