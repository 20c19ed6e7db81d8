"""Good and rejected rows from one pass; its counts; limits that stop publication."""

import os

import pytest
from pyspark.sql import functions as F

from creditpath.operators.validate import split_valid
from creditpath.sources import validated as V

SCHEMA = "uid string, channel string, time timestamp, conversion int"


def touches(spark, n):
    rows = spark.range(n)
    return rows.select(
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("u"), F.col("id"))).alias("uid"),
        F.when(F.col("id") % 7 > 0, "Email").otherwise("a > b").alias("channel"),
        F.timestamp_seconds("id").alias("time"), F.lit(0).alias("conversion"),
    )


def test_sides_and_counts(spark, tmp_path):
    given = touches(spark, 1000)
    out = V.write_validated(given, str(tmp_path / "v"))
    good, bad = split_valid(given)
    assert out.n_rows == 1000
    for mine, theirs in ((out.good, good), (out.rejected, bad)):
        assert mine.columns == theirs.columns
        assert mine.exceptAll(theirs).count() == 0 and theirs.exceptAll(mine).count() == 0
    counted = {r["reject_reason"]: r["count"] for r in bad.groupBy("reject_reason").count().collect()}
    assert {k: n for k, n in out.reasons.items() if n} == counted


def test_input_is_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    V.write_validated(touches(spark, 500).mapInArrow(count, SCHEMA), str(tmp_path / "o"))
    assert read.value == 500


def test_too_many_rejected_leaves_what_was_published(spark, tmp_path):
    path = str(tmp_path / "l")
    with pytest.raises(FileNotFoundError):
        V.read_validated(spark, path, touches(spark, 0).schema)
    V.write_validated(touches(spark, 10).where("uid is not null and channel = 'Email'"), path, max_rejected=0.0)
    with pytest.raises(V.TooManyRejected):
        V.write_validated(touches(spark, 1000), path, max_rejected=0.1)
    good, bad = V.read_validated(spark, path, touches(spark, 0).schema)
    assert good.count() == 8 and bad.count() == 0
    assert len([d for d in os.listdir(path) if d.startswith("_version-")]) == 1
    V.write_validated(touches(spark, 1000), path, max_rejected=0.3)
    assert V.read_validated(spark, path, touches(spark, 0).schema)[0].count() + V.read_validated(spark, path, touches(spark, 0).schema)[1].count() == 1000


def test_empty_input(spark, tmp_path):
    out = V.write_validated(touches(spark, 0), str(tmp_path / "e"), max_rejected=0.0)
    assert out.n_rows == 0 and out.good.count() == 0 and out.rejected.count() == 0
