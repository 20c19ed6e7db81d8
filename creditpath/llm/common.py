"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditpath.config import checkpoint_root, table_path

#: Arrow batches are worked off in slices of about this many characters.
CHUNK_CHARS = 1 << 19


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the session's shared checkpoint folder and cut the lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


class Shared:
    """A broadcast value of bounded size; its classes travel along, so that executors need no copy of this package."""

    def __init__(self, spark: SparkSession, value):
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self.packed.value)


def set_aside(df: DataFrame, names: set[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(df)`` with input columns that have one of these names renamed meanwhile, in whatever case they are written."""
    taken = {c.lower() for c in df.columns} | names
    away: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in names:
            fresh = f"{c}_aside"
            while fresh.lower() in taken:
                fresh += "_"
            taken.add(fresh.lower())
            away[c] = fresh
    return work(df.withColumnsRenamed(away)).withColumnsRenamed({v: k for k, v in away.items()}) if away else work(df)


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def text_slices(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``limit`` characters, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def batch_slices(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, int, list[str]]]:
    """Ranges of a batch's rows with about CHUNK_CHARS bytes of text, and their texts; null counts as empty.

    Only one range is held as Python strings at a time.
    """
    column = batch.column(name)
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if size and size + n > CHUNK_CHARS:
            yield start, i, [t or "" for t in column.slice(start, i - start).to_pylist()]
            start, size = i, 0
        size += n
    if start < len(column):
        yield start, len(column), [t or "" for t in column.slice(start).to_pylist()]


def ragged_take(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen rows of a ragged array, concatenated, and their lengths."""
    begin = offsets[rows]
    count = offsets[rows + 1] - begin
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(begin - (ends - count), count)
    return flat[at], count
