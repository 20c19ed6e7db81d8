"""Files of one folder with headers of their own: order, width, quoting, repeats, and files without one."""

import os

import pytest

from creditpath.config import shared_dir
from creditpath.sources.files import CORRUPT, SOURCE_FILE, read_touch_csv
from creditpath.streaming import ingest as S

FILES = {
    "a.csv": "uid,channel,time,conversion\nu1,Email,2024-01-01 10:00:00,1\n\nu2,Social,2024-01-01 11:00:00,0\n",
    "b.csv": "channel,uid,conversion,time\nSearch,u3,1,2024-01-01 12:00:00\nSearch,u4,1\n",
    "c.csv": '﻿"Time","conversion","ad_id","USER_ID","note","event_type"\r\n2024-01-01 13:00:00,0,x,u5,"a, ""b""",Email\r\n',
    "d.csv": "uid,time,conversion\nu6,2024-01-01 14:00:00,1\n",
    "e.csv": "conversion,uid,channel,time\n1,u7,Email,2024-01-01 15:00:00\nconversion,uid,channel,time\n0,u8,,2024-01-01 16:00:00,more\n",
    "f.csv": "",
}
GOOD = [
    ("u1", "Email", "2024-01-01 10:00:00", 1), ("u2", "Social", "2024-01-01 11:00:00", 0),
    ("u3", "Search", "2024-01-01 12:00:00", 1), ("u5", "Email", "2024-01-01 13:00:00", 0),
    ("u7", "Email", "2024-01-01 15:00:00", 1),
]
BAD = {("b.csv", "Search,u4,1"), ("d.csv", "uid,time,conversion"), ("d.csv", "u6,2024-01-01 14:00:00,1"),
       ("e.csv", "0,u8,,2024-01-01 16:00:00,more")}


@pytest.fixture
def folder(spark):
    path = f"{shared_dir(spark, 'headers')}/raw".removeprefix("file:")
    os.makedirs(path)
    for name, text in FILES.items():
        with open(f"{path}/{name}", "w", newline="") as f:
            f.write(text)
    return path


def plain(rows):
    return sorted((r.uid, r.channel, str(r.time), r.conversion) for r in rows)


def names(rows):
    return {(r[SOURCE_FILE].rpartition("/")[2], r[CORRUPT]) for r in rows}


def test_batch(spark, folder):
    rows = read_touch_csv(spark, folder).collect()
    assert plain(r for r in rows if r[CORRUPT] is None) == GOOD
    bad = [r for r in rows if r[CORRUPT] is not None]
    assert names(bad) == BAD
    assert all((r.uid, r.channel, r.time, r.conversion) == (None,) * 4 for r in bad)


def test_stream_with_quarantine_and_restart(spark, folder):
    base = folder.rpartition("/")[0]
    for k in range(3):
        query = S.start_ingest(
            S.touch_file_stream(spark, folder, max_files_per_trigger=2),
            S.parquet_batch_writer(f"{base}/data", quarantine=f"{base}/quarantine"),
            f"{base}/checkpoint",
        )
        S.finish(query, 300)
        late = GOOD
        if k == 2:
            late = sorted([*GOOD, ("u9", "Social", "2024-01-02 10:00:00", 1)])
        assert plain(spark.read.parquet(f"{base}/data").collect()) == late
        assert names(spark.read.parquet(f"{base}/quarantine").collect()) == BAD
        if k == 1:
            with open(f"{folder}/g.csv", "w") as f:
                f.write("time;ignored\n".replace(";", ",uid,conversion,channel,") + "2024-01-02 10:00:00,u9,1,Social,z\n")


def test_separator_and_named_columns(spark):
    path = f"{shared_dir(spark, 'headers')}/raw".removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("who;what;when;bought\nu1;Email, mostly;2024-01-01 10:00:00;1\n")
    mapping = {"uid": "who", "channel": "what", "time": "when", "conversion": "bought"}
    rows = read_touch_csv(spark, path, mapping=mapping, separator=";").collect()
    assert plain(rows) == [("u1", "Email, mostly", "2024-01-01 10:00:00", 1)]


def test_header_of_a_file_read_in_parts(spark):
    """A file over several tasks, among others whose names would fit by position."""
    path = f"{shared_dir(spark, 'headers')}/raw".removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/long.csv", "w") as f:
        f.write("channel,uid,conversion,time\n")
        f.writelines(f"Email,u{i},{i % 2},2024-01-01 10:00:00\n" for i in range(5000))
    with open(f"{path}/other.csv", "w") as f:
        f.write("uid,channel,time,conversion\nx,Social,2024-01-01 10:00:00,1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_touch_csv(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 5001 and all(r[CORRUPT] is None for r in rows)
    assert {r.channel for r in rows if r.uid != "x"} == {"Email"} and {r.uid for r in rows if r.channel == "Social"} == {"x"}
