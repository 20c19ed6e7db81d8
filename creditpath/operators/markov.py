"""Markov-chain attribution: scenario graphs, conversion probability, effects.

A scenario is the full graph (``removed_channel`` NULL) or the graph without
one channel: its rows are dropped and edges into it go to ``Null``.

Conversion probability from ``Start`` has three policies:

``absorbing``
    probability of reaching ``Conversion`` in the absorbing chain (loops
    allowed). The chain is reduced state by state, exactly but for rounding,
    with every channel left out once (:mod:`absorbing`).
``simple_path``
    sum over walks that never repeat a state. Level-by-level frontier join;
    walks that share (visited set, current state) are merged each level, yet
    the frontier is exponential in the number of channels: for few channels.
    :func:`simple_path_bounds` takes any number of them, for two bounds.
``memo_walk``
    a depth-first sum that keeps a state's value once it is left, with the
    next states visited in descending name order (values depend on it).

``memo_walk`` deals the scenarios out to tasks, which all hold the edges as
numbers, up to MAX_EDGES of them; beyond that this sequential rule refuses.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CONVERSION_STATE, MARKOV_CHAIN, NULL_STATE, START_STATE, checkpoint_root
from ..functions.numeric import round_half_even
from .absorbing import absorbing_probability as reduce_chain

REMOVED = "removed_channel"
PROB = "conversion_probability"
POLICIES = ("absorbing", "simple_path", "memo_walk")

#: Edges that may travel to every task.
MAX_EDGES = 2_000_000

_PROB_SCHEMA = T.StructType(
    [T.StructField(REMOVED, T.StringType(), True), T.StructField(PROB, T.DoubleType(), True)]
)


def channels(matrix: DataFrame) -> DataFrame:
    """Channels = every start state except ``Start``."""
    return (
        matrix.select(F.col("start_state").alias("channel"))
        .where(F.col("channel") != START_STATE)
        .distinct()
    )


def scenarios(matrix: DataFrame) -> DataFrame:
    """One row per scenario: NULL and every channel."""
    none = matrix.sparkSession.range(1).select(F.lit(None).cast("string").alias(REMOVED))
    return channels(matrix).select(F.col("channel").alias(REMOVED)).unionByName(none)


def _without(graph: DataFrame, removed) -> DataFrame:
    """Edges into the removed channel go to ``Null``, merged with an edge that is there."""
    end = F.when(F.col("end_state") == removed, NULL_STATE).otherwise(F.col("end_state"))
    return graph.withColumn("end_state", end)


def scenario_graph(matrix: DataFrame) -> DataFrame:
    """``removed_channel, start_state, end_state, transition_probability`` of all scenarios."""
    removed = F.col(REMOVED)
    kept = matrix.join(scenarios(matrix), removed.isNull() | (F.col("start_state") != removed))
    return (
        _without(kept, removed)
        .groupBy(REMOVED, "start_state", "end_state")
        .agg(F.sum("transition_probability").alias("transition_probability"))
    )


def removal_graph(matrix: DataFrame, channel: str | None) -> DataFrame:
    """``start_state, end_state, transition_probability`` of one scenario (``None``: the full graph)."""
    if channel is None:
        return matrix.select("start_state", "end_state", "transition_probability")
    kept = matrix.where(F.col("start_state") != channel)
    return (
        _without(kept, F.lit(channel))
        .groupBy("start_state", "end_state")
        .agg(F.sum("transition_probability").alias("transition_probability"))
    )


def _small_edges(matrix: DataFrame) -> pa.Table | None:
    """The edges, or None if there are too many to travel."""
    table = (
        matrix.select("start_state", "end_state", "transition_probability").limit(MAX_EDGES + 1).toArrow()
    )
    return table if table.num_rows <= MAX_EDGES else None


def _by_scenario(matrix: DataFrame, edges: pa.Table, prepare) -> DataFrame:
    """A row per scenario; ``prepare`` makes of numbered edges a function from the removed state to its probability.

    States are numbered in the order of their names; tasks get numbers only.
    """
    spark = matrix.sparkSession
    start, end = (edges.column(c).to_numpy(zero_copy_only=False) for c in ("start_state", "end_state"))
    names, number = np.unique(np.concatenate([start, end, [START_STATE, CONVERSION_STATE, NULL_STATE]]).astype(str), return_inverse=True)
    n = len(start)
    known = {s: int(i) for s, i in zip((START_STATE, CONVERSION_STATE, NULL_STATE), number[2 * n :])}
    shared = spark.sparkContext.broadcast((number[:n], number[n : 2 * n], edges.column("transition_probability").to_numpy(), known))
    channels_ = sorted(set(start) - {START_STATE})
    of = dict(zip(names.tolist(), range(len(names))))
    rows = spark.createDataFrame([(None, None), *((c, of[c]) for c in channels_)], f"{REMOVED} string, number long")

    def run(batches):
        probability = prepare(*shared.value)
        for batch in batches:
            values = [probability(c) for c in batch.column("number").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(REMOVED), pa.array(values, pa.float64())], names=[REMOVED, PROB]
            )

    return rows.mapInArrow(run, _PROB_SCHEMA)


# --------------------------------------------------------------------------
# policy: absorbing


def absorbing_probability(matrix: DataFrame) -> DataFrame:
    """``removed_channel, conversion_probability`` under the absorbing policy, for every scenario."""
    return reduce_chain(matrix, REMOVED, PROB)


# --------------------------------------------------------------------------
# policy: memo_walk


def _memo_walk(descending: bool):
    """A state's value is the sum over its next states of probability times value: 1 for
    ``Conversion``; 0 for ``Null``, the removed channel and states that are open; what
    was stored when a state was closed; else the next state is opened first.
    """

    def prepare(starts: np.ndarray, ends: np.ndarray, p: np.ndarray, known: dict[str, int]):
        # edges of a state are a stretch of the arrays, in the order of their ends
        order = np.lexsort((p, ends, starts))
        starts, ends, p = starts[order], ends[order], p[order]
        step = -1 if descending else 1

        def after(state: int):
            low, high = np.searchsorted(starts, [state, state + 1])
            return zip(ends[low:high][::step].tolist(), p[low:high][::step].tolist())

        first = known[START_STATE]

        def probability(removed: int | None) -> float:
            stored = {known[CONVERSION_STATE]: 1.0, known[NULL_STATE]: 0.0}
            if removed is not None:
                stored[removed] = 0.0
            opened, todo, total = [first], {first: after(first)}, {first: 0.0}
            weight = {first: 1.0}
            while opened:
                state = opened[-1]
                step = next(todo[state], None)
                if step is None:
                    opened.pop()
                    stored[state] = total.pop(state)
                    del todo[state]
                    if opened:
                        total[opened[-1]] += weight[state] * stored[state]
                    continue
                end, q = step
                if end in todo:
                    continue
                if end in stored:
                    total[state] += q * stored[end]
                else:
                    opened.append(end)
                    todo[end], total[end], weight[end] = after(end), 0.0, q
            return stored[first]

        return probability

    return prepare


def memo_walk_probability(matrix: DataFrame, descending: bool = True) -> DataFrame:
    """Memoised walk of every scenario; next states in descending (default) or ascending name order."""
    edges = _small_edges(matrix)
    if edges is None:
        raise ValueError(f"memo_walk takes at most {MAX_EDGES} edges; use the absorbing policy")
    if not edges.num_rows:
        return scenarios(matrix).where(F.lit(False)).withColumn(PROB, F.lit(0.0))
    return _by_scenario(matrix, edges, _memo_walk(descending))


# --------------------------------------------------------------------------
# policy: simple_path


def simple_path_probability(matrix: DataFrame, checkpoint_every: int = 8) -> DataFrame:
    """Sum over walks from ``Start`` to ``Conversion`` that repeat no state, for every scenario."""
    graph = scenario_graph(matrix)
    checkpoint_root(graph.sparkSession)
    # The graph is small (states^2 per scenario). Write it once to the shared
    # checkpoint folder: every level then reads it instead of re-deriving it
    # from the touches, and the lineage stays short.
    edges = graph.select(
        F.col(REMOVED).alias("_r"),
        F.col("start_state").alias("_s"),
        F.col("end_state").alias("_e"),
        F.col("transition_probability").alias("_p"),
    ).checkpoint(eager=True)
    n_states = edges.select("_s").distinct().count()

    scen = edges.select(F.col("_r").alias(REMOVED)).distinct()
    frontier = scen.select(
        REMOVED,
        F.lit(START_STATE).alias("state"),
        F.array().cast("array<string>").alias("visited"),
        F.lit(1.0).alias("mass"),
    )
    # Mass that reached Conversion stays in the frontier as one sink row per
    # scenario (empty visited set), so the plan grows by one join and one
    # aggregation per level and the answer is read off the last frontier.
    sink = F.col("state") == CONVERSION_STATE
    # A simple path visits Start and each channel at most once, then ends:
    # at most (number of start states) edges, so that many levels suffice.
    for level in range(n_states):
        moving = frontier.where(~sink).join(
            edges, F.col(REMOVED).eqNullSafe(F.col("_r")) & (F.col("state") == F.col("_s"))
        ).where(~F.array_contains("visited", F.col("_e")) & (F.col("_e") != NULL_STATE))
        moved = moving.select(
            REMOVED,
            F.col("_e").alias("state"),
            F.when(F.col("_e") == CONVERSION_STATE, F.array().cast("array<string>"))
            .otherwise(F.array_sort(F.array_union("visited", F.array(F.col("_e")))))
            .alias("visited"),
            (F.col("mass") * F.col("_p")).alias("mass"),
        )
        frontier = (
            frontier.where(sink)
            .unionByName(moved)
            .groupBy(REMOVED, "state", "visited")
            .agg(F.sum("mass").alias("mass"))
        )
        if checkpoint_every and (level + 1) % checkpoint_every == 0 and level < n_states - 1:
            frontier = frontier.checkpoint(eager=True)
    sums = frontier.where(sink).select(F.col(REMOVED).alias("_sr"), F.col("mass").alias("_sp"))
    return scen.join(sums, scen[REMOVED].eqNullSafe(sums["_sr"]), "left").select(
        REMOVED, F.coalesce(F.col("_sp"), F.lit(0.0)).alias(PROB)
    )


LOWER, UPPER = "lower_bound", "upper_bound"


def simple_path_bounds(matrix: DataFrame, floor: float = 1e-4) -> DataFrame:
    """``removed_channel, lower_bound, upper_bound`` of the simple-path probability, for every scenario.

    Walks that share visited states and the current one are merged; what is
    then less likely than ``floor`` isn't followed any further, and its mass,
    the most that it could still have added, goes to the upper bound alone. A
    level has at most 1 / ``floor`` such rows a scenario, however many channels
    there are. With a floor of 0 both bounds are the probability.
    """
    if not 0 <= floor <= 1:
        raise ValueError("the floor is a probability")
    graph = scenario_graph(matrix)
    checkpoint_root(graph.sparkSession)
    edges = graph.where(F.col("end_state") != NULL_STATE).select(
        F.coalesce(REMOVED, F.lit("")).alias("_r"), F.col("start_state").alias("state"),
        F.col("end_state").alias("_e"), F.col("transition_probability").alias("_p"),
    ).checkpoint()
    scen = graph.select(REMOVED).distinct().withColumn("_r", F.coalesce(REMOVED, F.lit(""))).checkpoint()
    none = F.array().cast("array<string>")
    moving = scen.select("_r", F.lit(START_STATE).alias("state"), F.array(F.lit(START_STATE)).alias("visited"), F.lit(1.0).alias("mass"))
    ended = scen.select("_r", F.lit(0.0).alias(LOWER), F.lit(0.0).alias("_cut"))
    while True:
        stepped = moving.join(edges, ["_r", "state"]).where(~F.array_contains("visited", F.col("_e"))).select(
            "_r", F.col("_e").alias("state"),
            F.when(F.col("_e") == CONVERSION_STATE, none)
            .otherwise(F.array_sort(F.concat("visited", F.array("_e")))).alias("visited"),
            (F.col("mass") * F.col("_p")).alias("mass"),
        )
        level = stepped.groupBy("_r", "state", "visited").agg(F.sum("mass").alias("mass")).checkpoint()
        converted = F.col("state") == CONVERSION_STATE
        small = ~converted & (F.col("mass") < floor)
        now = level.groupBy("_r").agg(
            F.sum(F.when(converted, F.col("mass")).otherwise(0.0)).alias(LOWER),
            F.sum(F.when(small, F.col("mass")).otherwise(0.0)).alias("_cut"),
        )
        ended = ended.unionByName(now).groupBy("_r").agg(F.sum(LOWER).alias(LOWER), F.sum("_cut").alias("_cut")).checkpoint()
        moving = level.where(~converted & ~small)
        if moving.isEmpty():
            break
    upper = F.least(F.lit(1.0), F.col(LOWER) + F.col("_cut")).alias(UPPER)
    return scen.join(ended, "_r").select(REMOVED, LOWER, upper)


def conversion_probability(matrix: DataFrame, policy: str = "absorbing") -> DataFrame:
    if policy == "absorbing":
        return absorbing_probability(matrix)
    if policy == "simple_path":
        return simple_path_probability(matrix)
    if policy == "memo_walk":
        return memo_walk_probability(matrix)
    raise ValueError(f"unknown policy {policy!r}; use one of {POLICIES}")


# --------------------------------------------------------------------------
# removal effect and attribution


def removal_effect(probabilities: DataFrame, digits: int | None = None) -> DataFrame:
    """``channel, conversion_probability, removal_effect, attribution_percent``.

    ``removal_effect = (P - P_without)/P`` (NULL when P is 0) and the share is
    the effect over the sum of effects. ``digits`` rounds the effect first and
    the share after (banker's rounding), as the notebook did.
    """
    everything = Window.partitionBy()
    base = F.max(F.when(F.col(REMOVED).isNull(), F.col(PROB))).over(everything)
    effects = probabilities.select(
        F.col(REMOVED).alias("channel"),
        F.col(PROB),
        round_half_even(F.try_divide(base - F.col(PROB), base), digits).alias("removal_effect"),
    ).where(F.col("channel").isNotNull())
    total = F.sum("removal_effect").over(everything)
    return effects.select(
        "channel",
        PROB,
        "removal_effect",
        round_half_even(F.try_divide(F.col("removal_effect"), total), digits).alias(
            "attribution_percent"
        ),
    )


def markov_attribution(effects: DataFrame) -> DataFrame:
    """``attribution_model, channel, attribution_percent`` rows of the Markov model."""
    return effects.select(
        F.lit(MARKOV_CHAIN).alias("attribution_model"), "channel", "attribution_percent"
    )
