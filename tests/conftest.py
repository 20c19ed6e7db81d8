import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from creditpath.config import local_session

    work = tempfile.mkdtemp(prefix="creditpath-test-")
    s = local_session(
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.sql.warehouse.dir": os.path.join(work, "warehouse"),
            "spark.checkpoint.dir": os.path.join(work, "checkpoint"),
        },
    )
    yield s
    s.stop()


@pytest.fixture
def toy_touches(spark):
    """FIXTURES F1: five hand-checkable journeys."""
    from pyspark.sql import functions as F

    rows = [
        ("u1", "Social", "2024-01-01 10:00:00", 0, 1),
        ("u1", "Email", "2024-01-01 11:00:00", 1, 2),
        ("u2", "Email", "2024-01-01 10:00:00", 0, 3),
        ("u3", "Social", "2024-01-01 10:00:00", 0, 4),
        ("u3", "Social", "2024-01-01 12:00:00", 0, 5),
        ("u4", "Email", "2024-01-01 09:00:00", 0, 6),
        ("u4", "Social", "2024-01-01 09:30:00", 1, 7),
        ("u5", "Search", "2024-01-01 08:00:00", 1, 8),
    ]
    df = spark.createDataFrame(rows, "uid string, channel string, t string, conversion int, event_id long")
    return df.select("uid", "channel", F.to_timestamp("t").alias("time"), "conversion", "event_id")
