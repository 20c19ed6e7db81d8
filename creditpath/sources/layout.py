"""File layout of tables: files of a wanted size along a Z-order curve, and reads that skip files.

One key is served by a plain range sort (:func:`catalog.clustered`). For two
or more keys the rows go along a Z-order curve: each key's value is replaced
by its rank among quantiles of the key, so that skewed and clustered values
use all of the curve, and the ranks' bits are interleaved. Files are equal
ranges of the curve, hence narrow in every key. A curve cell is divided
further by the keys and a hash of the row, so a value that a third of the
rows share doesn't end in one file.

:func:`file_ranges` gives every file's least and greatest keys;
:func:`read_files` reads only files whose ranges meet the wanted ones.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import bucket_of, quantile_cuts
from .catalog import MAX_RETRIES, RETENTION_S, VERSION, VersionLog, _publish, table_location

#: Bits of a key's rank, if the position's 62 bits allow that many for each key.
BITS = 8
#: Bytes of a file that optimize_table writes.
FILE_BYTES = 256 << 20
_Z, _HASH = "_cp_z", "_cp_hash"


def z_position(df: DataFrame, keys: list[str], bits: int = BITS) -> Column:
    """Place on the Z-order curve over the keys' quantile ranks, as a long; NULL is a key's least value."""
    bits = min(bits, 62 // len(keys))
    n = df.count()
    cuts = [quantile_cuts(df, [k], 1 << bits, n) for k in keys]
    # a frequent value takes all the places of its quantiles, so that few distinct values use the curve too
    ranks = [bucket_of(F.struct(k), list(c.values()), list(c)) for k, c in zip(keys, cuts)]
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(one, bit * len(keys) + i))
    return place


def z_ordered(df: DataFrame, keys: list[str], files: int, bits: int = BITS) -> DataFrame:
    """The rows in ``files`` partitions, equal ranges of the curve, sorted along it."""
    placed = df.withColumn(_Z, z_position(df, keys, bits)).withColumn(_HASH, F.xxhash64(*df.columns))
    # ranges are cut from a sample of positions; the hash spreads rows that are equal in all keys
    dealt = placed.repartitionByRange(files, _Z, *keys, _HASH).sortWithinPartitions(_Z, *keys)
    return dealt.drop(_Z, _HASH)


def file_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each file of a table that was read from files: file, n_rows, and least_k, most_k, nulls_k of each key."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[f(k).alias(f"{name}_{k}") for k in keys for f, name in ((F.min, "least"), (F.max, "most"))],
        *[F.count_if(F.col(k).isNull()).alias(f"nulls_{k}") for k in keys],
    )


def _literal(value, kind: str) -> Column:
    """A bound; a naive datetime for a column without a time zone keeps its wall clock."""
    return F.lit(str(value)).cast(kind) if kind == "timestamp_ntz" else F.lit(value)


def _between(column: Column, bounds: tuple, kind: str) -> Column:
    low, high = bounds
    tests = [] if low is None else [column >= _literal(low, kind)]
    tests += [] if high is None else [column <= _literal(high, kind)]
    return reduce(lambda a, b: a & b, tests, column.isNotNull())


def files_for(ranges: DataFrame, wanted: dict[str, tuple]) -> list[str]:
    """Files that may hold rows with every wanted key between its bounds; a bound that is None is open."""
    kinds = dict(ranges.dtypes)
    meets = F.lit(True)
    for k, (low, high) in wanted.items():
        least, most = f"least_{k}", f"most_{k}"
        meets = meets & _between(F.col(most), (low, None), kinds[most]) & _between(F.col(least), (None, high), kinds[least])
    # a name for each file, as in the listing that Spark's reader makes on the driver
    return [r.file for r in ranges.where(meets).select("file").orderBy("file").collect()]


def read_files(df: DataFrame, ranges: DataFrame, wanted: dict[str, tuple]) -> DataFrame:
    """Rows of ``df``, a table read from Parquet files, with every wanted key between its bounds, from the files that may hold them."""
    found = files_for(ranges, wanted)
    if not found:
        return df.limit(0)
    rows, kinds = df.sparkSession.read.schema(df.schema).parquet(*found), dict(df.dtypes)
    return rows.where(reduce(lambda a, b: a & b, [_between(F.col(k), bounds, kinds[k]) for k, bounds in wanted.items()]))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the data files right in a folder, without the versions and logs below it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sum(f.getLen() for f in found if f.isFile() and not f.getPath().getName().startswith(("_", ".")))


def optimize_table(
    spark: SparkSession, table: str, keys: list[str], file_bytes: int = FILE_BYTES, retention_s: float = RETENTION_S
) -> DataFrame:
    """Rewrites a Parquet table as files of about ``file_bytes`` along the Z-order curve over ``keys``.

    Small files are thereby put together and large ones divided. The rows stay
    the same. The new files are a version of their own, committed in the
    table's log as by :func:`catalog.upsert`: a reader sees the one or the
    other, and rows that another writer commits meanwhile are not lost, since
    the work is then done anew on its version.
    """
    root = table_location(spark, table).split(VERSION)[0]
    log = VersionLog(spark, root)
    columns = spark.table(table).columns
    for _ in range(MAX_RETRIES):
        number, version = log.latest()
        now = version or root
        rows = spark.read.schema(spark.table(table).schema).parquet(now).select(*columns)
        files = max(1, math.ceil(folder_bytes(spark, now) / file_bytes))
        new = f"{root}{VERSION}{uuid.uuid4().hex[:12]}"
        z_ordered(rows, keys, files).write.mode("errorifexists").parquet(new)
        if log.commit(number + 1, new):
            _publish(spark, table, log)
            log.clean(2, retention_s)
            return spark.table(table)
    raise RuntimeError(f"other writers were first {MAX_RETRIES} times; {table} was not rewritten")
