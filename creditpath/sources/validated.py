"""One write of good and rejected touches, measured while it runs, and published only within its limits."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.validate import REASON, reject_reason
from .catalog import MAX_RETRIES, VERSION, VersionLog

REASONS = ("missing uid", "missing time", "missing channel", "reserved channel name", "separator in channel name")
_REJECTED = "rejected"


class TooManyRejected(ValueError):
    """More rows than allowed failed validation; nothing was published."""


@dataclass
class Written:
    """Rows written, rows of each reject reason, and the two sides read back from the published folder."""

    n_rows: int
    reasons: dict[str, int]
    good: DataFrame
    rejected: DataFrame


def write_validated(touches: DataFrame, path: str, max_rejected: float = 1.0) -> Written:
    """Writes all touches below ``path``, good and rejected rows side by side, from one pass over the input.

    Counts are taken by ``observe`` in the write itself. If more than
    ``max_rejected`` of the rows (a share) fail validation, TooManyRejected is
    raised, and what readers see stays as it was. Otherwise the new folder
    becomes the next version in the log below ``path``; versions before it
    stay on disk. If tasks are lost and run again, counts may include a row
    twice; the rows themselves are written once. An empty input publishes
    empty sides. Input columns named reject_reason or rejected are replaced.
    """
    spark = touches.sparkSession
    tagged = touches.withColumn(REASON, reject_reason()).withColumn(_REJECTED, F.col(REASON).isNotNull())
    seen = Observation(f"validated {uuid.uuid4().hex}")
    counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(REASON) == r).alias(r) for r in REASONS]]
    new = f"{path.rstrip('/')}{VERSION}{uuid.uuid4().hex[:12]}"
    tagged.observe(seen, *counts).write.mode("errorifexists").partitionBy(_REJECTED).parquet(new)
    got = seen.get
    reasons = {r: got[r] for r in REASONS}
    log = VersionLog(spark, path)
    if sum(reasons.values()) > max_rejected * got["n"]:
        log.fs.delete(log._path(new), True)
        raise TooManyRejected(f"{sum(reasons.values())} of {got['n']} rows were rejected: {reasons}")
    for _ in range(MAX_RETRIES):
        if log.commit(log.latest()[0] + 1, new):
            good, rejected = read_validated(spark, path, touches.schema)
            return Written(got["n"], reasons, good, rejected)
    raise RuntimeError(f"other writers were first {MAX_RETRIES} times; nothing was published")


def read_validated(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Good and rejected rows (the latter with their reason) of the last published version; ``schema`` is the touches'."""
    version = VersionLog(spark, path).latest()[1]
    if version is None:
        raise FileNotFoundError(f"nothing was published in {path}")
    whole = StructType([f for f in schema if f.name not in (REASON, _REJECTED)]).add(REASON, "string").add(_REJECTED, "boolean")
    rows = spark.read.schema(whole).parquet(version)
    good = rows.where(~F.col(_REJECTED)).drop(REASON, _REJECTED)
    return good, rows.where(F.col(_REJECTED)).drop(_REJECTED)
