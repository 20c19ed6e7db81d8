"""JDBC sink logic without a database: the writer's calls go to an in-memory stand-in.

No server or embedded database is started; this checks only what our callback
does: tag rows with the batch id, and replace what an attempt of a batch left.
"""

import pytest
from pyspark.sql import DataFrameWriter

from creditpath.sources.jdbc import _quoted, jdbc_properties
from creditpath.streaming.ingest import BATCH_ID, jdbc_batch_writer


def test_half_written_batch_is_replayed_whole(spark, monkeypatch):
    tables = {}
    fail = []

    def fake_write(self, url, table, mode=None, properties=None):
        rows = self._df.collect()
        assert mode == "overwrite"
        if fail:
            tables[table] = rows[:1]  # one task has committed
            raise RuntimeError(fail.pop())
        tables[table] = rows

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_write)
    props = jdbc_properties(user="u", password="p", driver="d")
    assert props == {"user": "u", "password": "p", "driver": "d"}
    write = jdbc_batch_writer("jdbc:none", "bronze", props)
    batch0 = spark.createDataFrame([("u1", "Email"), ("u2", "Search"), ("u4", "x")], "uid string, channel string")
    batch1 = spark.createDataFrame([("u3", "Social")], "uid string, channel string")
    fail.append("connection lost")
    with pytest.raises(RuntimeError):
        write(batch0, 0)
    assert len(tables["bronze_batch_0"]) == 1
    write(batch0, 0)
    write(batch0, 0)  # and once more after a restart
    write(batch1, 1)
    stored = sorted((r.uid, r[BATCH_ID]) for rows in tables.values() for r in rows)
    assert stored == [("u1", 0), ("u2", 0), ("u3", 1), ("u4", 0)]


def test_option_values_are_quoted():
    assert _quoted("a'b") == "'a\\'b'"
