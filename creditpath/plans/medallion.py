"""The raw -> bronze -> gold flow as jobs over a ``TableLayout``.

``ingest``: CSV files of raw touches, either layout -> typed bronze Parquet
(file stream, run once, checkpointed; lines that don't fit go to quarantine).
``build_gold``: bronze -> ``gold_user_journey`` (save-once, one row per touch,
range-clustered by uid and position) and ``gold_attribution`` (rows of all
three models merged in on every run).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import TableLayout
from ..sources import catalog as C
from ..streaming import ingest as S
from .attribution import AttributionPlan

KEYS = ["attribution_model", "channel"]


def ingest(
    spark: SparkSession, layout: TableLayout, time_format: str | None = None,
    timeout_s: float | None = None, mapping: dict[str, str] | None = None,
) -> DataFrame:
    """Run the file stream once over ``layout.raw_path`` into ``layout.bronze_path``; whole or an error."""
    bronze = layout.bronze_path
    q = S.start_ingest(
        S.touch_file_stream(spark, layout.raw_path),
        S.parquet_batch_writer(f"{bronze}/data", quarantine=f"{bronze}/quarantine"),
        f"{bronze}/checkpoint",
        time_format=time_format,
        mapping=mapping,
    )
    S.finish(q, timeout_s)
    data = spark.read.parquet(f"{bronze}/data").drop(S.BATCH_ID)
    if data.isEmpty() and not spark.read.parquet(f"{bronze}/quarantine").isEmpty():
        raise ValueError("no columns of touches in any header; the files' lines are in quarantine")
    return data


def build_gold(
    spark: SparkSession,
    layout: TableLayout,
    touches: DataFrame,
    policy: str = "absorbing",
    digits: int | None = None,
) -> dict[str, DataFrame]:
    """Write the gold tables for ``touches``; returns them read back from the catalog.

    Attribution rows of every model are replaced: channels that a model no
    longer names leave the table.
    """
    db = layout.database
    C.create_database(spark, db)
    plan = AttributionPlan(touches, policy=policy, digits=digits)
    journey_table = f"{db}.gold_user_journey"
    if not spark.catalog.tableExists(journey_table):
        C.save_once(C.clustered(plan.user_journey, ["uid", "seq"]), journey_table, path=layout.gold_user_journey_path)
    attribution_table = f"{db}.gold_attribution"
    markov = plan.markov_attribution()
    rows = plan.touch_attribution.unionByName(markov)
    C.save_once(rows.limit(0), attribution_table, path=layout.gold_attribution_path)
    gold = C.upsert(spark, attribution_table, rows, KEYS, prune=["attribution_model"])
    return {
        "gold_user_journey": spark.table(journey_table),
        "gold_attribution": gold,
        "markov_chain_attribution_update": markov,
    }


def main(argv: list[str] | None = None) -> None:
    import argparse

    from ..config import local_session
    from ..sources.events import touches as event_touches

    ap = argparse.ArgumentParser(description="attribution gold tables")
    ap.add_argument("--events-dir", help="directory with events.parquet")
    ap.add_argument("--raw", help="directory of raw touch CSV files (streamed to bronze)")
    ap.add_argument("--out", required=True, help="base folder for bronze and gold tables")
    ap.add_argument("--database", default="attribution")
    ap.add_argument("--policy", default="absorbing")
    ap.add_argument("--master", default="local[8]")
    a = ap.parse_args(argv)
    spark = local_session(master=a.master)
    layout = TableLayout(
        database=a.database, raw_path=a.raw, bronze_path=f"{a.out}/bronze",
        gold_user_journey_path=f"{a.out}/gold_user_journey",
        gold_attribution_path=f"{a.out}/gold_attribution",
    )
    if a.raw:
        touches = ingest(spark, layout)
    else:
        touches = event_touches(spark, a.events_dir)
    gold = build_gold(spark, layout, touches, policy=a.policy)
    gold["gold_attribution"].orderBy("attribution_model", "channel").show(50, truncate=False)


if __name__ == "__main__":
    main()
