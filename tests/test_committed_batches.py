"""Stream batches are seen whole or not at all, and once."""

import os

import pytest
from pyspark.sql.types import StructType

from creditpath.sources import catalog as C
from creditpath.sources.files import CORRUPT, SOURCE_FILE
from creditpath.streaming import ingest as S

SCHEMA = StructType().add("uid", "string").add("channel", "string").add("time", "timestamp").add("conversion", "integer")
LINES = StructType().add(CORRUPT, "string").add(SOURCE_FILE, "string")


def rows(spark, path):
    return sorted(r.uid for r in S.read_committed(spark, path, SCHEMA).collect())


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(["uid,channel,time,conversion", *lines]) + "\n")


def ingest(spark, base):
    q = S.start_ingest(S.touch_file_stream(spark, f"{base}/raw"), S.committed_batch_writer(f"{base}/bronze"), f"{base}/checkpoint")
    S.finish(q, 120)


def test_failed_batch_leaves_nothing_and_its_retry_gives_each_row_once(spark, tmp_path, monkeypatch):
    base, bronze = str(tmp_path), str(tmp_path / "bronze")
    assert rows(spark, bronze) == []
    put(f"{base}/raw", "a.csv", ["u1,Email,2024-01-01 10:00:00,0", "u2,Email,2024-01-01 11:00:00,1"])
    ingest(spark, base)
    assert rows(spark, bronze) == ["u1", "u2"]
    put(f"{base}/raw", "b.csv", ["u3,Email,2024-01-02 10:00:00,0", "u4,Email,2024-01-02 11:00:00,1,9,9"])

    commit, seen = C.VersionLog.commit, []

    def killed(self, number, version):
        seen.append((number, rows(spark, bronze)))  # the batch is staged whole, and not yet seen
        raise OSError("the driver is gone")

    monkeypatch.setattr(C.VersionLog, "commit", killed)
    with pytest.raises(Exception, match="driver is gone"):
        ingest(spark, base)
    assert seen == [(2, ["u1", "u2"])]
    assert rows(spark, bronze) == ["u1", "u2"]
    monkeypatch.setattr(C.VersionLog, "commit", commit)
    ingest(spark, base)
    assert rows(spark, bronze) == ["u1", "u2", "u3"]
    lines = S.read_committed(spark, bronze, LINES, "quarantine").collect()
    assert [(r[CORRUPT].startswith("u4"), r[SOURCE_FILE].endswith("b.csv")) for r in lines] == [(True, True)]
    ingest(spark, base)
    assert rows(spark, bronze) == ["u1", "u2", "u3"]


def test_replayed_and_raced_batches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "b")
    one = spark.createDataFrame([("u1", "Email", None, 0)], SCHEMA)
    write = S.committed_batch_writer(path)
    write(one, 0)
    write(one, 0)
    assert rows(spark, path) == ["u1"]
    monkeypatch.setattr(C.VersionLog, "has", lambda self, number: False)  # both attempts are past the look
    write(one, 0)
    assert rows(spark, path) == ["u1"]
    assert len([d for d in os.listdir(path) if d.startswith("_version-")]) == 1
