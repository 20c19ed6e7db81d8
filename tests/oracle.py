"""Compare a registered Spark query with its DuckDB oracle (rows, columns, values)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        p = os.path.join(p, "*.parquet") if os.path.isdir(p) else p
        if os.path.exists(p) or "*" in p:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in row) for row in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s = spark_df.toPandas()
    # as the correctness run does: the text must also stand as a view
    con.execute(f"CREATE OR REPLACE TEMP VIEW oracle_text AS {sql}")
    d = con.execute("SELECT * FROM oracle_text").df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count {len(s)} vs {len(d)}"
    rs, rd = _rows(s), _rows(d)
    for a, b in zip(rs, rd):
        if a != b:
            return False, f"first differing row: {a} vs {b}"
    return True, f"{len(s)} rows"
