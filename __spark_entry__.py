"""

Every query reads the driver's ``events`` table (touch = non-purchase event
of a user-day, see ``creditpath.sources.events``) and runs over all of it.
Doubles whose value depends on summation order are rounded to 9 digits on
both sides; arrays are shown as text so both engines print them alike.
"""

from __future__ import annotations

import datetime
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from creditpath.config import shared_dir  # noqa: E402
from creditpath.functions.paths import register_sql_functions, terminal_state  # noqa: E402
from creditpath.operators import transitions as TR  # noqa: E402
from creditpath.operators.markov import simple_path_bounds  # noqa: E402
from creditpath.plans.attribution import AttributionPlan  # noqa: E402
from creditpath.sources import catalog as C  # noqa: E402
from creditpath.sources import layout as LY  # noqa: E402
from creditpath.sources import validated as VW  # noqa: E402
from creditpath.sources.events import read_events, touches_from_events  # noqa: E402
from creditpath.streaming import ingest as S  # noqa: E402

FLAGSHIP_SF = "/root/testdata/sf0.001"
DIGITS = 9


def _r(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in cols})


def _plan(spark: SparkSession, sf_dir: str, **kw) -> AttributionPlan:
    return AttributionPlan.from_events(spark, sf_dir, **kw)


def entry(spark: SparkSession) -> DataFrame:
    """First- and last-touch shares of converting journeys at sf0.001."""
    return _plan(spark, FLAGSHIP_SF).touch_attribution


# --------------------------------------------------------------------------
# queries


def q_touches_clean(spark, sf):
    return _plan(spark, sf).touches


def _dirty_events(spark, sf):
    """The events with faults put in by rules on the event id, the same in both engines."""
    ev = read_events(spark, sf)
    n = F.col("event_id")
    kind = F.col("event_type")
    channel = (
        F.when(n % 29 == 1, F.lit(None).cast("string"))
        .when(n % 31 == 2, F.lit("  "))
        .when(n % 37 == 3, F.lit("Start"))
        .when(n % 41 == 4, F.concat(kind, F.lit(" > x")))
        .when((n % 5 == 0) & (kind != "purchase"), F.concat(F.lit(" "), kind, F.lit("  ")))
        .otherwise(kind)
    )
    return ev.withColumns({"user_id": F.when(n % 23 != 0, F.col("user_id")), "event_type": channel})


def _dirty_plan(spark, sf):
    return AttributionPlan(touches_from_events(_dirty_events(spark, sf)))


def q_touches_rejected(spark, sf):
    return _dirty_plan(spark, sf).rejected


def q_dirty_transitions(spark, sf):
    """Edges straight from touches (E1), with padded and rejected channels among them."""
    return _dirty_plan(spark, sf).transition_counts


def q_dirty_path_transitions(spark, sf):
    """The same counts by way of the stored journey's text pairs."""
    edges = TR.edges_from_path_transitions(_dirty_plan(spark, sf).path_transitions)
    return TR.transition_counts(edges)


def q_text_transitions(spark, sf):
    """Path text of each touch and its neighbours, split by the SQL function."""
    uj = _plan(spark, sf).user_journey
    path = F.concat_ws(" > ", F.coalesce("previous_channel", F.lit("Start")), "channel")
    tail = F.when(F.col("seq") == F.col("n_touches"), terminal_state("conversion"))
    uj.select("uid", "seq", F.concat_ws(" > ", path, tail).alias("path")).createOrReplaceTempView("journey_steps")
    register_sql_functions(spark)
    split = "SELECT uid, seq, path, transition_array(path) AS pairs FROM journey_steps"
    return spark.sql(f"SELECT uid, seq, path, explode(pairs) AS transition FROM ({split})")


def q_visit_order(spark, sf):
    return _plan(spark, sf).visit_order


def q_journey_summary(spark, sf):
    return _plan(spark, sf).journeys


def q_converting_journeys(spark, sf):
    from creditpath.operators.touch_models import converting_journeys

    return converting_journeys(_plan(spark, sf).journeys)


def q_user_journey(spark, sf):
    return _plan(spark, sf).user_journey


def q_first_touch(spark, sf):
    return _plan(spark, sf).first_touch


def q_last_touch(spark, sf):
    return _plan(spark, sf).last_touch


def q_touch_attribution(spark, sf):
    return _plan(spark, sf).touch_attribution


def q_touch_attribution_rounded(spark, sf):
    return _plan(spark, sf, digits=2).touch_attribution


def q_path_transitions(spark, sf):
    return _plan(spark, sf).path_transitions


def q_touch_transitions(spark, sf):
    return _plan(spark, sf).edges


def q_transition_counts(spark, sf):
    return _plan(spark, sf).transition_counts


def q_transition_matrix(spark, sf):
    return _plan(spark, sf).matrix


def q_transition_row_sums(spark, sf):
    return _plan(spark, sf).row_sums


def q_transition_pivot(spark, sf):
    p = _plan(spark, sf).pivot()
    return _r(p, *[c for c in p.columns if c != "start_state"])


def q_transition_adjacency(spark, sf):
    a = _plan(spark, sf).adjacency
    return a.select(
        "start_state",
        F.array_join("next_stages", ",").alias("next_stages"),
        F.array_join(
            F.transform(
                "next_stage_transition_probabilities",
                lambda p: F.round(p, DIGITS).cast("decimal(12,9)").cast("string"),
            ),
            ",",
        ).alias("next_stage_transition_probabilities"),
    )


def q_removal_graph(spark, sf):
    return _r(_plan(spark, sf).scenario_graph, "transition_probability")


def q_removal_graph_one(spark, sf):
    """The graph without the channel ``click``."""
    return _r(_plan(spark, sf).removal_graph("click"), "transition_probability")


def q_conversion_prob_absorbing(spark, sf):
    return _r(_plan(spark, sf).conversion_probability("absorbing"), "conversion_probability")


def q_conversion_prob_many_channels(spark, sf):
    """Absorbing probability with some hundreds of channels: an event's type and the number in its properties."""
    detail = F.concat("event_type", F.lit("-"), F.regexp_extract("props", "([0-9]+)", 1))
    events = read_events(spark, sf).withColumn("event_type", F.when(F.col("event_type") == "purchase", "purchase").otherwise(detail))
    plan = AttributionPlan(touches_from_events(events))
    return _r(plan.conversion_probability("absorbing"), "conversion_probability")


def q_conversion_prob_simple_path(spark, sf):
    return _r(_plan(spark, sf).conversion_probability("simple_path"), "conversion_probability")


def q_simple_path_bounds(spark, sf):
    """Both bounds of the simple-path probability when walks under one in fifty aren't followed."""
    return _r(simple_path_bounds(_plan(spark, sf).matrix, floor=0.02), "lower_bound", "upper_bound")


def q_conversion_prob_memo_walk(spark, sf):
    return _r(_plan(spark, sf).conversion_probability("memo_walk"), "conversion_probability")


def q_removal_effect(spark, sf):
    return _r(
        _plan(spark, sf).removal_effect("absorbing"),
        "conversion_probability",
        "removal_effect",
        "attribution_percent",
    )


def q_removal_effect_simple_path(spark, sf):
    return _r(
        _plan(spark, sf).removal_effect("simple_path"),
        "conversion_probability",
        "removal_effect",
        "attribution_percent",
    )


def q_removal_effect_rounded(spark, sf):
    """Effects rounded to 2 digits before normalising, shares rounded again (original output)."""
    return _r(_plan(spark, sf, digits=2).removal_effect("absorbing"), "conversion_probability")


def q_markov_attribution(spark, sf):
    return _r(_plan(spark, sf).markov_attribution("absorbing"), "attribution_percent")


def q_markov_attribution_memo_walk(spark, sf):
    return _r(_plan(spark, sf).markov_attribution("memo_walk"), "attribution_percent")


def q_all_models(spark, sf):
    return _r(_plan(spark, sf).all_models("absorbing"), "attribution_percent")


def q_attribution_pivot(spark, sf):
    p = _plan(spark, sf).attribution_pivot("absorbing")
    return _r(p, "first_touch", "last_touch", "markov_chain")


def q_attribution_upsert(spark, sf):
    """Gold table holds 2-digit touch shares; merge in fresh last-touch and Markov rows."""
    plan = _plan(spark, sf)
    target = plan.touch_attribution.withColumn(
        "attribution_percent", F.round("attribution_percent", 2)
    )
    source = plan.last_touch.unionByName(plan.markov_attribution("absorbing"))
    merged = C.upsert_into_new_table(
        spark, target, source, ["attribution_model", "channel"], name="gold_attribution"
    )
    return _r(merged, "attribution_percent")


def q_gold_refresh(spark, sf):
    """Gold after a second run: rows of the first, over the first half of the events, are replaced."""
    half = read_events(spark, sf).where(F.col("event_id") % 2 == 0)
    first = AttributionPlan(touches_from_events(half)).touch_attribution
    old = first.withColumn("channel", F.concat(F.lit("old "), "channel")).unionByName(first)
    now = _plan(spark, sf).all_models("absorbing")
    merged = C.upsert_into_new_table(
        spark, old, now, ["attribution_model", "channel"], name="gold_attribution", prune=["attribution_model"]
    )
    return _r(merged, "attribution_percent")


def q_clustered_journey(spark, sf):
    return C.write_clustered(spark, _plan(spark, sf).user_journey, ["uid", "seq"], name="gold_user_journey")


def q_zorder_journey(spark, sf):
    """The journeys in files along a Z-order curve over uid and channel, read back."""
    out = shared_dir(spark, "zorder_journey")
    rows = _plan(spark, sf).user_journey.checkpoint()
    LY.z_ordered(rows, ["uid", "channel"], 16).write.parquet(out)
    return spark.read.parquet(out)


def q_optimized_events(spark, sf):
    """Events of the middle half of the user ids in one week, from those files of an optimized table that may hold them."""
    table = f"events_{shared_dir(spark, 'x').rpartition('-')[2]}"
    path = shared_dir(spark, table)
    C.save_once(read_events(spark, sf).select("event_id", "user_id", "ts", "event_type"), table, path=path)
    keys = ["user_id", "ts"]
    rows = LY.optimize_table(spark, table, keys, max(1, LY.folder_bytes(spark, path) // 24))
    least, most = rows.agg(F.min("user_id"), F.max("user_id")).first()
    quarter = ((most or 0) - (least or 0)) // 4
    users = ((least or 0) + quarter, (most or 0) - quarter)
    week = datetime.datetime(2024, 1, 8), datetime.datetime(2024, 1, 14, 23, 59, 59, 999999)
    return LY.read_files(rows, LY.file_ranges(rows, keys), {"user_id": users, "ts": week})


def q_validated_write(spark, sf):
    """Rows of either side of one validated write, with the counts that the write itself took."""
    out = VW.write_validated(_dirty_plan(spark, sf).raw_touches.drop("prev_touch"), shared_dir(spark, "validated"), max_rejected=0.9)
    counted = F.create_map(*[x for r, n in out.reasons.items() for x in (F.lit(r), F.lit(n).cast("long"))])
    n_good = F.lit(out.n_rows - sum(out.reasons.values())).cast("long")
    good = out.good.withColumn("reject_reason", F.lit(None).cast("string")).withColumn("n_alike", n_good)
    return good.unionByName(out.rejected.withColumn("n_alike", counted[F.col("reject_reason")]))


def _plain_touches(spark, sf):
    return _plan(spark, sf).touches.select("uid", "channel", "time", "conversion")


def q_stream_ingest(spark, sf):
    return S.roundtrip_through_stream(spark, _plain_touches(spark, sf))


def q_header_stream(spark, sf):
    """The six-column raw layout, its columns found by their names in the header."""
    return S.roundtrip_through_stream(spark, _plain_touches(spark, sf), six_columns=True)


def q_mixed_headers(spark, sf):
    """Files of four column orders and widths in one folder, each read by its own header."""
    return S.layouts_roundtrip(spark, _plain_touches(spark, sf), streamed=False)


def q_mixed_header_stream(spark, sf):
    return S.layouts_roundtrip(spark, _plain_touches(spark, sf), streamed=True)


def q_catalog_roundtrip(spark, sf):
    """Transition counts through a database table and a view, with the table's description beside them."""
    here = spark.catalog.currentDatabase()
    C.create_database(spark, "cp_roundtrip")
    try:
        if not C.use_database(spark, "cp_roundtrip") or C.use_database(spark, "cp_roundtrip_missing"):
            raise RuntimeError("databases are not told apart")
        table = f"counts_{shared_dir(spark, 'x').rpartition('-')[2]}"
        C.save_once(_plan(spark, sf).transition_counts, table, path=shared_dir(spark, table))
        spark.table(table).createOrReplaceTempView("counts_view")
        types = C.describe(spark, table).select(F.concat_ws(" ", "col_name", "data_type").alias("c"))
        described = types.agg(F.array_join(F.array_sort(F.collect_list("c")), ", ").alias("described"))
        rows = spark.sql("SELECT start_state, end_state, total_transitions FROM counts_view")
        return rows.join(F.broadcast(described))  # one row
    finally:
        spark.catalog.setCurrentDatabase(here)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "touches_clean": q_touches_clean,
    "touches_rejected": q_touches_rejected,
    "dirty_transitions": q_dirty_transitions,
    "dirty_path_transitions": q_dirty_path_transitions,
    "text_transitions": q_text_transitions,
    "visit_order": q_visit_order,
    "journey_summary": q_journey_summary,
    "converting_journeys": q_converting_journeys,
    "user_journey": q_user_journey,
    "first_touch": q_first_touch,
    "last_touch": q_last_touch,
    "touch_attribution": q_touch_attribution,
    "touch_attribution_rounded": q_touch_attribution_rounded,
    "path_transitions": q_path_transitions,
    "touch_transitions": q_touch_transitions,
    "transition_counts": q_transition_counts,
    "transition_matrix": q_transition_matrix,
    "transition_row_sums": q_transition_row_sums,
    "transition_pivot": q_transition_pivot,
    "transition_adjacency": q_transition_adjacency,
    "removal_graph": q_removal_graph,
    "removal_graph_one": q_removal_graph_one,
    "conversion_prob_absorbing": q_conversion_prob_absorbing,
    "conversion_prob_many_channels": q_conversion_prob_many_channels,
    "conversion_prob_simple_path": q_conversion_prob_simple_path,
    "simple_path_bounds": q_simple_path_bounds,
    "conversion_prob_memo_walk": q_conversion_prob_memo_walk,
    "removal_effect": q_removal_effect,
    "removal_effect_simple_path": q_removal_effect_simple_path,
    "removal_effect_rounded": q_removal_effect_rounded,
    "markov_attribution": q_markov_attribution,
    "markov_attribution_memo_walk": q_markov_attribution_memo_walk,
    "all_models": q_all_models,
    "attribution_pivot": q_attribution_pivot,
    "attribution_upsert": q_attribution_upsert,
    "clustered_journey": q_clustered_journey,
    "zorder_journey": q_zorder_journey,
    "optimized_events": q_optimized_events,
    "validated_write": q_validated_write,
    "stream_ingest": q_stream_ingest,
    "header_stream": q_header_stream,
    "mixed_headers": q_mixed_headers,
    "mixed_header_stream": q_mixed_header_stream,
    "catalog_roundtrip": q_catalog_roundtrip,
    "gold_refresh": q_gold_refresh,
}


try:  # the training-data operators and their pipeline may be absent
    import corpus_pipeline
    from creditpath.llm import queries as _llm
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "creditpath.llm", "creditpath.llm.queries"):
        raise
    _LLM_QUERIES, _LLM_ORACLES = {}, {}
else:
    _LLM_QUERIES = _llm.QUERIES | {"pipeline": corpus_pipeline.run}
    _LLM_ORACLES = _llm.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _LLM_QUERIES


# --------------------------------------------------------------------------
# DuckDB oracles (written directly in SQL, independent of the Spark code)

_BASE = """
ev AS (
    SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS uid,
           event_type AS channel, ts AS time, event_id
    FROM events
),
ev_next AS (
    SELECT *, lead(channel) OVER (PARTITION BY uid ORDER BY time, event_id) AS next_type
    FROM ev
),
touches AS (
    SELECT uid, channel, time,
           CAST(CASE WHEN next_type = 'purchase' THEN 1 ELSE 0 END AS INTEGER) AS conversion,
           event_id
    FROM ev_next
    WHERE channel IS DISTINCT FROM 'purchase'
),
ranked AS (
    SELECT *,
           row_number() OVER (PARTITION BY uid ORDER BY time, event_id) AS rn_first,
           row_number() OVER (PARTITION BY uid ORDER BY time DESC, event_id DESC) AS rn_last,
           lag(channel) OVER (PARTITION BY uid ORDER BY time, event_id) AS prev_channel,
           dense_rank() OVER (PARTITION BY uid ORDER BY time) AS visit_order
    FROM touches
),
journeys AS (
    SELECT uid,
           max(CASE WHEN rn_first = 1 THEN channel END) AS first_interaction,
           max(CASE WHEN rn_last = 1 THEN channel END) AS last_interaction,
           max(CASE WHEN rn_last = 1 THEN conversion END) AS conversion,
           count(*) AS n_touches
    FROM ranked
    GROUP BY uid
),
user_journey AS (
    SELECT r.uid, r.rn_first AS seq, r.visit_order, r.prev_channel AS previous_channel, r.channel,
           j.first_interaction, j.last_interaction, j.conversion, j.n_touches
    FROM ranked r JOIN journeys j ON j.uid = r.uid
),
first_touch AS (
    SELECT 'first_touch' AS attribution_model, first_interaction AS channel,
           count(*) / (SELECT count(*) FROM journeys WHERE conversion = 1) AS attribution_percent
    FROM journeys WHERE conversion = 1 GROUP BY first_interaction
),
last_touch AS (
    SELECT 'last_touch' AS attribution_model, last_interaction AS channel,
           count(*) / (SELECT count(*) FROM journeys WHERE conversion = 1) AS attribution_percent
    FROM journeys WHERE conversion = 1 GROUP BY last_interaction
),
edges AS (
    SELECT uid, coalesce(prev_channel, 'Start') AS start_state, channel AS end_state FROM ranked
    UNION ALL
    SELECT uid, last_interaction AS start_state,
           CASE WHEN conversion = 1 THEN 'Conversion' ELSE 'Null' END AS end_state
    FROM journeys
),
counts AS (
    SELECT start_state, end_state, count(*) AS total_transitions FROM edges GROUP BY ALL
),
matrix AS (
    SELECT start_state, end_state,
           total_transitions / sum(total_transitions) OVER (PARTITION BY start_state)
             AS transition_probability
    FROM counts
),
chans AS (SELECT DISTINCT start_state AS ch FROM matrix WHERE start_state <> 'Start'),
scen AS (SELECT CAST(NULL AS VARCHAR) AS removed_channel UNION ALL SELECT ch FROM chans),
graph AS (
    SELECT s.removed_channel, m.start_state,
           CASE WHEN m.end_state = s.removed_channel THEN 'Null' ELSE m.end_state END AS end_state,
           sum(m.transition_probability) AS transition_probability
    FROM matrix m, scen s
    WHERE s.removed_channel IS NULL OR m.start_state <> s.removed_channel
    GROUP BY ALL
),
prop(step, removed_channel, state, mass) AS (
    SELECT 0, removed_channel, 'Start', CAST(1.0 AS DOUBLE) FROM scen
    UNION ALL
    SELECT p.step + 1, p.removed_channel, g.end_state, sum(p.mass * g.transition_probability)
    FROM prop p JOIN graph g
      ON g.removed_channel IS NOT DISTINCT FROM p.removed_channel AND g.start_state = p.state
    WHERE p.step < 400
    GROUP BY ALL
),
absorbing AS (
    SELECT s.removed_channel,
           coalesce(sum(p.mass) FILTER (WHERE p.state = 'Conversion'), 0) AS conversion_probability
    FROM scen s LEFT JOIN prop p ON p.removed_channel IS NOT DISTINCT FROM s.removed_channel
    GROUP BY s.removed_channel
),
walks(removed_channel, state, visited, mass) AS (
    SELECT removed_channel, 'Start', ['Start'], CAST(1.0 AS DOUBLE) FROM scen
    UNION ALL
    SELECT w.removed_channel, g.end_state, list_append(w.visited, g.end_state),
           w.mass * g.transition_probability
    FROM walks w JOIN graph g
      ON g.removed_channel IS NOT DISTINCT FROM w.removed_channel AND g.start_state = w.state
    WHERE w.state NOT IN ('Conversion', 'Null') AND NOT list_contains(w.visited, g.end_state)
),
merged(removed_channel, state, visited, mass) AS (
    SELECT removed_channel, 'Start', ['Start'], CAST(1.0 AS DOUBLE) FROM scen
    UNION ALL
    SELECT m.removed_channel, g.end_state, list_sort(list_append(m.visited, g.end_state)), sum(m.mass * g.transition_probability)
    FROM merged m JOIN graph g
      ON g.removed_channel IS NOT DISTINCT FROM m.removed_channel AND g.start_state = m.state
    WHERE m.state <> 'Conversion' AND m.mass >= 0.02 AND g.end_state <> 'Null' AND NOT list_contains(m.visited, g.end_state)
    GROUP BY ALL
),
simple_path AS (
    SELECT s.removed_channel,
           coalesce(sum(w.mass) FILTER (WHERE w.state = 'Conversion'), 0) AS conversion_probability
    FROM scen s LEFT JOIN walks w ON w.removed_channel IS NOT DISTINCT FROM s.removed_channel
    GROUP BY s.removed_channel
),
kids AS (
    SELECT removed_channel, start_state AS state,
           list({'e': end_state, 'p': transition_probability} ORDER BY end_state DESC) AS kids
    FROM graph GROUP BY ALL
),
opened(removed_channel, path, pos, tot, wt, mk, mv) AS (
    SELECT removed_channel, ['Start'], [1], [CAST(0 AS DOUBLE)], [CAST(0 AS DOUBLE)],
           CAST([] AS VARCHAR[]), CAST([] AS DOUBLE[]) FROM scen
    UNION ALL
    SELECT removed_channel,
           CASE act WHEN 'close' THEN path[1:n - 1] WHEN 'open' THEN list_append(path, k.e) ELSE path END,
           CASE WHEN act = 'close' AND n = 1 THEN CAST([] AS INTEGER[])
                WHEN act = 'close' THEN list_append(pos[1:n - 2], pos[n - 1] + 1)
                WHEN act = 'open' THEN list_append(pos, 1)
                ELSE list_append(pos[1:n - 1], pos[n] + 1) END,
           CASE WHEN act = 'close' AND n = 1 THEN CAST([] AS DOUBLE[])
                WHEN act = 'close' THEN list_append(tot[1:n - 2], tot[n - 1] + wt[n] * tot[n])
                WHEN act = 'open' THEN list_append(tot, 0)
                WHEN act = 'one' THEN list_append(tot[1:n - 1], tot[n] + k.p)
                WHEN act = 'kept' THEN list_append(tot[1:n - 1], tot[n] + k.p * mv[list_position(mk, k.e)])
                ELSE tot END,
           CASE act WHEN 'close' THEN wt[1:n - 1] WHEN 'open' THEN list_append(wt, k.p) ELSE wt END,
           CASE act WHEN 'close' THEN list_append(mk, path[n]) ELSE mk END,
           CASE act WHEN 'close' THEN list_append(mv, tot[n]) ELSE mv END
    FROM (
        SELECT *, CASE WHEN k IS NULL THEN 'close' WHEN k.e = 'Conversion' THEN 'one'
                       WHEN k.e = 'Null' OR list_contains(path, k.e) THEN 'zero'
                       WHEN list_contains(mk, k.e) THEN 'kept' ELSE 'open' END AS act
        FROM (SELECT o.*, len(o.path) AS n, c.kids[o.pos[len(o.pos)]] AS k
              FROM opened o LEFT JOIN kids c
                ON c.removed_channel IS NOT DISTINCT FROM o.removed_channel AND c.state = o.path[len(o.path)]
              WHERE len(o.path) > 0)
    )
),
memo_walk AS (
    SELECT removed_channel, mv[list_position(mk, 'Start')] AS conversion_probability FROM opened WHERE len(path) = 0
),
effect_memo AS (
    SELECT removed_channel AS channel, conversion_probability,
           (max(conversion_probability) FILTER (WHERE removed_channel IS NULL) OVER () - conversion_probability)
           / max(conversion_probability) FILTER (WHERE removed_channel IS NULL) OVER () AS removal_effect
    FROM memo_walk
),
effect_absorbing AS (
    SELECT removed_channel AS channel, conversion_probability,
           (max(conversion_probability) FILTER (WHERE removed_channel IS NULL) OVER ()
             - conversion_probability)
           / max(conversion_probability) FILTER (WHERE removed_channel IS NULL) OVER ()
             AS removal_effect
    FROM absorbing
),
share_absorbing AS (
    SELECT channel, conversion_probability, removal_effect,
           removal_effect / sum(removal_effect) OVER () AS attribution_percent
    FROM effect_absorbing WHERE channel IS NOT NULL
),
effect_simple AS (
    SELECT removed_channel AS channel, conversion_probability,
           (max(conversion_probability) FILTER (WHERE removed_channel IS NULL) OVER ()
             - conversion_probability)
           / max(conversion_probability) FILTER (WHERE removed_channel IS NULL) OVER ()
             AS removal_effect
    FROM simple_path
),
share_simple AS (
    SELECT channel, conversion_probability, removal_effect,
           removal_effect / sum(removal_effect) OVER () AS attribution_percent
    FROM effect_simple WHERE channel IS NOT NULL
),
markov AS (
    SELECT 'markov_chain' AS attribution_model, channel, attribution_percent FROM share_absorbing
),
all_models AS (
    SELECT * FROM first_touch UNION ALL SELECT * FROM last_touch UNION ALL SELECT * FROM markov
)
"""


def _with(body: str) -> str:
    return "WITH RECURSIVE " + _BASE.strip() + "\n" + body.strip()


#: End states of the given events, for the pivot's columns.
_STATES = ["Conversion", "Null", "click", "error", "signup", "view"]

_DIRTY = """
    WITH d_ev AS (
        SELECT CASE WHEN event_id % 23 <> 0 THEN user_id END AS user_id, ts AS time, event_id,
               CASE WHEN event_id % 29 = 1 THEN NULL WHEN event_id % 31 = 2 THEN '  '
                    WHEN event_id % 37 = 3 THEN 'Start' WHEN event_id % 41 = 4 THEN event_type || ' > x'
                    WHEN event_id % 5 = 0 AND event_type <> 'purchase' THEN ' ' || event_type || '  '
                    ELSE event_type END AS channel
        FROM events
    ),
    d_uid AS (
        SELECT *, CAST(user_id AS VARCHAR) || '-' || strftime(time, '%Y%m%d') AS uid FROM d_ev
    ),
    d_next AS (
        SELECT *, lead(channel) OVER (PARTITION BY uid ORDER BY time, event_id) AS next_type FROM d_uid
    ),
    judged AS (
        SELECT uid, channel, time, event_id,
               CAST(CASE WHEN next_type = 'purchase' AND uid IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS conversion,
               CASE WHEN uid IS NULL OR trim(uid) = '' THEN 'missing uid'
                    WHEN time IS NULL THEN 'missing time'
                    WHEN channel IS NULL OR trim(channel) = '' THEN 'missing channel'
                    WHEN trim(channel) IN ('Start', 'Conversion', 'Null') THEN 'reserved channel name'
                    WHEN strpos(channel, '>') > 0 THEN 'separator in channel name' END AS reject_reason
        FROM d_next WHERE channel IS DISTINCT FROM 'purchase'
    ),
    d_ok AS (
        SELECT uid, trim(channel) AS channel, conversion,
               lag(trim(channel)) OVER w AS before, lead(channel) OVER w AS after
        FROM judged WHERE reject_reason IS NULL WINDOW w AS (PARTITION BY uid ORDER BY time, event_id)
    ),
    dirty_edges AS (
        SELECT coalesce(before, 'Start') AS start_state, channel AS end_state FROM d_ok
        UNION ALL
        SELECT channel, CASE WHEN conversion = 1 THEN 'Conversion' ELSE 'Null' END FROM d_ok WHERE after IS NULL
    ),
    dirty_counts AS (
        SELECT start_state, end_state, count(*) AS total_transitions FROM dirty_edges GROUP BY ALL
    )
"""

#: Stands alone: mass moved step by step, for every channel left out, until none is on the way.
_MANY_CHANNELS = """
WITH RECURSIVE typed AS (
    SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS uid, ts, event_id,
           CASE WHEN event_type = 'purchase' THEN 'purchase'
                ELSE event_type || '-' || regexp_extract(props, '([0-9]+)', 1) END AS channel
    FROM events
), ahead AS (
    SELECT *, lead(channel) OVER (PARTITION BY uid ORDER BY ts, event_id) AS next_channel FROM typed
), touched AS (
    SELECT uid, channel, next_channel IS NOT DISTINCT FROM 'purchase' AS converts,
           lag(channel) OVER (PARTITION BY uid ORDER BY ts, event_id) AS before,
           lead(channel) OVER (PARTITION BY uid ORDER BY ts, event_id) IS NULL AS is_last
    FROM ahead WHERE channel <> 'purchase'
), steps AS (
    SELECT coalesce(before, 'Start') AS a, channel AS b FROM touched
    UNION ALL
    SELECT channel, CASE WHEN converts THEN 'Conversion' ELSE 'Null' END FROM touched WHERE is_last
), graph AS (
    SELECT a, b, count(*) / sum(count(*)) OVER (PARTITION BY a) AS p FROM steps GROUP BY a, b
), scen AS (
    SELECT CAST(NULL AS VARCHAR) AS removed UNION ALL SELECT DISTINCT a FROM graph WHERE a <> 'Start'
), moving(step, removed, state, mass) AS (
    SELECT 0, removed, 'Start', CAST(1.0 AS DOUBLE) FROM scen
    UNION ALL
    SELECT step + 1, removed, b, sum(mass * p) FROM moving JOIN graph ON a = state
    WHERE b <> 'Null' AND b IS DISTINCT FROM removed
    GROUP BY ALL HAVING sum(mass * p) > 1e-15
)
SELECT removed AS removed_channel,
       round(coalesce(sum(mass) FILTER (WHERE state = 'Conversion'), 0), 9) AS conversion_probability
FROM moving GROUP BY removed
"""

_ORACLES = {
    "touches_clean": "SELECT uid, channel, time, conversion, event_id FROM touches",
    "touches_rejected": f"""
        SELECT uid, channel, time, conversion, event_id, reject_reason
        FROM ({_DIRTY} SELECT * FROM judged WHERE reject_reason IS NOT NULL)
    """,
    "dirty_transitions": f"SELECT * FROM ({_DIRTY} SELECT * FROM dirty_counts)",
    "dirty_path_transitions": f"SELECT * FROM ({_DIRTY} SELECT * FROM dirty_counts)",
    "text_transitions": """
        SELECT uid, seq, path, st[i] || ' > ' || st[i + 1] AS transition
        FROM (SELECT uid, seq, path, list_transform(string_split(path, '>'), lambda x: trim(x)) AS st
              FROM (SELECT uid, seq, coalesce(previous_channel, 'Start') || ' > ' || channel
                      || CASE WHEN seq < n_touches THEN '' WHEN conversion = 1 THEN ' > Conversion' ELSE ' > Null' END
                      AS path
                    FROM user_journey)) j,
             range(1, len(st)) AS r(i)
    """,
    "visit_order": "SELECT uid, channel, time, conversion, event_id, visit_order FROM ranked",
    "journey_summary": "SELECT * FROM journeys",
    "converting_journeys": """
        SELECT count(*) FILTER (WHERE conversion = 1) AS converting_journeys FROM journeys
    """,
    "user_journey": "SELECT * FROM user_journey",
    "first_touch": "SELECT * FROM first_touch",
    "last_touch": "SELECT * FROM last_touch",
    "touch_attribution": "SELECT * FROM first_touch UNION ALL SELECT * FROM last_touch",
    "touch_attribution_rounded": """
        SELECT attribution_model, channel, round(attribution_percent, 2) AS attribution_percent
        FROM (SELECT * FROM first_touch UNION ALL SELECT * FROM last_touch)
    """,
    "path_transitions": """
        SELECT uid, start_state || ' > ' || end_state AS transition, 1 AS cnt FROM edges
    """,
    "touch_transitions": "SELECT * FROM edges",
    "transition_counts": "SELECT * FROM counts",
    "transition_matrix": "SELECT * FROM matrix",
    "transition_row_sums": """
        SELECT start_state, round(sum(transition_probability), 2) AS transition_probability_sum
        FROM matrix GROUP BY start_state
    """,
    "transition_pivot": "SELECT start_state, "
    + ", ".join(
        f"max(round(transition_probability, 9)) FILTER (WHERE end_state = '{s}') AS \"{s}\"" for s in _STATES
    )
    + " FROM matrix GROUP BY start_state",
    "transition_adjacency": """
        SELECT start_state,
               string_agg(end_state, ',' ORDER BY end_state DESC) AS next_stages,
               string_agg(CAST(CAST(round(transition_probability, 9) AS DECIMAL(12, 9)) AS VARCHAR),
                          ',' ORDER BY end_state DESC) AS next_stage_transition_probabilities
        FROM matrix GROUP BY start_state
    """,
    "removal_graph": """
        SELECT removed_channel, start_state, end_state,
               round(transition_probability, 9) AS transition_probability
        FROM graph
    """,
    "removal_graph_one": """
        SELECT start_state, end_state, round(transition_probability, 9) AS transition_probability
        FROM graph WHERE removed_channel = 'click'
    """,
    "conversion_prob_absorbing": """
        SELECT removed_channel, round(conversion_probability, 9) AS conversion_probability
        FROM absorbing
    """,
    "conversion_prob_simple_path": """
        SELECT removed_channel, round(conversion_probability, 9) AS conversion_probability
        FROM simple_path
    """,
    "simple_path_bounds": """
        SELECT s.removed_channel,
               round(coalesce(sum(mass) FILTER (WHERE state = 'Conversion'), 0), 9) AS lower_bound,
               round(least(1, coalesce(sum(mass) FILTER (WHERE state = 'Conversion' OR mass < 0.02), 0)), 9) AS upper_bound
        FROM scen s LEFT JOIN merged m ON m.removed_channel IS NOT DISTINCT FROM s.removed_channel
        GROUP BY s.removed_channel
    """,
    "conversion_prob_memo_walk": """
        SELECT removed_channel, round(conversion_probability, 9) AS conversion_probability
        FROM memo_walk
    """,
    "markov_attribution_memo_walk": """
        SELECT 'markov_chain' AS attribution_model, channel,
               round(removal_effect / sum(removal_effect) OVER (), 9) AS attribution_percent
        FROM effect_memo WHERE channel IS NOT NULL
    """,
    "removal_effect": """
        SELECT channel, round(conversion_probability, 9) AS conversion_probability,
               round(removal_effect, 9) AS removal_effect,
               round(attribution_percent, 9) AS attribution_percent
        FROM share_absorbing
    """,
    "removal_effect_simple_path": """
        SELECT channel, round(conversion_probability, 9) AS conversion_probability,
               round(removal_effect, 9) AS removal_effect,
               round(attribution_percent, 9) AS attribution_percent
        FROM share_simple
    """,
    "removal_effect_rounded": """
        SELECT channel, round(conversion_probability, 9) AS conversion_probability,
               removal_effect,
               round_even(removal_effect / sum(removal_effect) OVER (), 2) AS attribution_percent
        FROM (SELECT channel, conversion_probability,
                     round_even(removal_effect, 2) AS removal_effect
              FROM share_absorbing)
    """,
    "markov_attribution": """
        SELECT attribution_model, channel, round(attribution_percent, 9) AS attribution_percent
        FROM markov
    """,
    "all_models": """
        SELECT attribution_model, channel, round(attribution_percent, 9) AS attribution_percent
        FROM all_models
    """,
    "attribution_pivot": """
        SELECT channel,
               round(max(attribution_percent) FILTER (WHERE attribution_model = 'first_touch'), 9)
                 AS first_touch,
               round(max(attribution_percent) FILTER (WHERE attribution_model = 'last_touch'), 9)
                 AS last_touch,
               round(max(attribution_percent) FILTER (WHERE attribution_model = 'markov_chain'), 9)
                 AS markov_chain
        FROM all_models GROUP BY channel
    """,
    "attribution_upsert": """
        SELECT attribution_model, channel, round(round(attribution_percent, 2), 9) AS attribution_percent
        FROM first_touch
        UNION ALL
        SELECT attribution_model, channel, round(attribution_percent, 9) FROM last_touch
        UNION ALL
        SELECT attribution_model, channel, round(attribution_percent, 9) FROM markov
    """,
    "clustered_journey": "SELECT * FROM user_journey",
    "zorder_journey": "SELECT * FROM user_journey",
    "optimized_events": """
        SELECT event_id, user_id, ts, event_type
        FROM events, (SELECT min(user_id) AS least, max(user_id) AS most FROM events) AS ids
        WHERE user_id BETWEEN least + (most - least) // 4 AND most - (most - least) // 4
          AND ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'
    """,
    "validated_write": f"""
        SELECT uid, channel, time, conversion, event_id, reject_reason, count(*) OVER (PARTITION BY reject_reason) AS n_alike
        FROM ({_DIRTY} SELECT * FROM judged)
    """,
    "stream_ingest": "SELECT uid, channel, time, conversion FROM touches",
    "header_stream": "SELECT uid, channel, time, conversion FROM touches",
    "mixed_headers": "SELECT uid, channel, time, conversion FROM touches",
    "mixed_header_stream": "SELECT uid, channel, time, conversion FROM touches",
    "catalog_roundtrip": """
        SELECT start_state, end_state, total_transitions,
               'end_state string, start_state string, total_transitions bigint' AS described
        FROM counts
    """,
    "gold_refresh": """
        SELECT attribution_model, channel, round(attribution_percent, 9) AS attribution_percent
        FROM all_models
    """,
}


def oracle_sql() -> dict[str, str]:
    return {k: _with(v) for k, v in _ORACLES.items()} | {"conversion_prob_many_channels": _MANY_CHANNELS} | _LLM_ORACLES
