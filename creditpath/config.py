"""Fixed state names, session helpers and the shared-folder convention.

Every function in the package takes the caller's ``SparkSession``; nothing
here creates or stops a session except :func:`local_session`, which tests and
``bench.py`` use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Fixed values (must match the attribution model's state names and path format).
START_STATE = "Start"
CONVERSION_STATE = "Conversion"
NULL_STATE = "Null"
PATH_SEPARATOR = " > "
RESERVED_STATES = (START_STATE, CONVERSION_STATE, NULL_STATE)
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Attribution model names written into ``attribution_model``.
FIRST_TOUCH = "first_touch"
LAST_TOUCH = "last_touch"
MARKOV_CHAIN = "markov_chain"


@dataclass(frozen=True)
class TableLayout:
    """Where the medallion tables live. Paths are parameters, never globals."""

    database: str = "attribution"
    raw_path: str | None = None
    bronze_path: str | None = None
    gold_user_journey_path: str | None = None
    gold_attribution_path: str | None = None


def local_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "creditpath",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the benchmark (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # Plans here are built from many small DataFrame calls; recording the
        # Python call site of each one costs more than running small queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names shared storage, so data written
    under it survives the loss of an executor. It is read from the session;
    only when it is unset (tests, local runs) is a folder of our own chosen.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            # a machine-local folder would not survive the loss of this host
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder (HDFS, object store) "
                "before running on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="creditpath-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under :func:`checkpoint_root`."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
