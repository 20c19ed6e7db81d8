"""Conversion probability of the absorbing chain, for the full graph and without each channel.

The chain is reduced state by state: a state that is taken out passes what
enters it on in proportion to its outgoing probabilities. Self-loops are never
read; what leaves a state is a sum of its other probabilities. So nothing is
ever subtracted, no number of steps has to be waited for, and each result is
right to a few units in its last digits however slowly the chain mixes.

To leave every channel out once, the channels are halved: taking one half out
leaves a chain in which only channels of the other half can still be the
missing one, and so on, down to chains with one channel. All of it costs a
small multiple of one reduction.

Chains of up to ``LOCAL_STATES`` channels are reduced to the end in one task
each, all chains side by side. Larger ones are held as panels of ``PANEL``
rows; a round takes a panel's states out of all panels of its chain, with the
panel sent to each. The arithmetic is the same in both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CONVERSION_STATE, NULL_STATE, START_STATE, checkpoint_root

LOCAL_STATES = 1024
PANEL = 512
#: States that are taken out by one matrix product.
STEP = 64

# Columns of a panel: one for each channel, then Start and the two ends.
START, CONVERTED, LOST, EXTRA = 0, 1, 2, 3

PANELS = "node long, panel long, states array<long>, columns array<long>, data binary"


def shares_of_exit(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For states (``rows``, in the columns ``at``), where what enters each first leaves them all."""
    rows = rows.copy()
    n = np.arange(len(at))
    rows[n, at] = 0
    for i, column in enumerate(at.tolist()):
        out = rows[i].sum()
        if out == 0:
            rows[i, rows.shape[1] - EXTRA + LOST] = out = 1.0  # no way out: what enters is lost
        passed = rows[:, column] / out
        passed[i] = 0
        rows += passed[:, None] * rows[i]
        rows[:, column] = 0
        rows[n, at] = 0
    return rows / rows.sum(axis=1, keepdims=True)


def take_out(rows: np.ndarray, at: np.ndarray, exits: np.ndarray) -> None:
    """Passes on what the rows send to the states in the columns ``at``."""
    rows += rows[:, at] @ exits
    rows[:, at] = 0


def reduced(chain: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The chain (a row and a column for each channel, Start's row last) without the channels ``gone``."""
    chain = chain.copy()
    left = np.ones(len(chain), bool)
    for low in range(0, len(gone), STEP):
        at = gone[low : low + STEP]
        exits = shares_of_exit(chain[at], at)
        left[at] = False
        rows = chain[left]
        take_out(rows, at, exits)
        chain[left] = rows
        np.fill_diagonal(chain, 0)
    return chain[left][:, np.concatenate([left[:-1], np.ones(EXTRA, bool)])]


def converted(chain: np.ndarray) -> float:
    """Share of Start's mass that converts; channels still in the chain are ends where it is lost."""
    row = chain[-1].copy()
    row[-EXTRA + START] = 0
    total = row.sum()
    return float(row[-EXTRA + CONVERTED] / total) if total else 0.0


def each_left_out(chain: np.ndarray, names: np.ndarray) -> Iterator[tuple[int, float]]:
    if len(names) == 1:
        yield int(names[0]), converted(chain)
        return
    half = len(names) // 2
    for keep in (np.arange(half), np.arange(half, len(names))):
        gone = np.setdiff1d(np.arange(len(names)), keep)
        yield from each_left_out(reduced(chain, gone), names[keep])


def full_and_each(chain: np.ndarray, names: np.ndarray, with_full: bool) -> Iterator[tuple[int | None, float]]:
    if with_full:
        yield None, converted(reduced(chain, np.arange(len(names))))
    if len(names):
        yield from each_left_out(chain, names)


def numbered_edges(matrix: DataFrame) -> tuple[DataFrame, int, DataFrame]:
    """Channels with their numbers, how many there are, and edges as numbers; -1 is Start, -2 Conversion, -3 what leads nowhere.

    Channels are numbered in the order of their names; the names alone pass
    through the driver. An edge into a state that no edge leaves is one into Null.
    """
    names = matrix.where(~F.col("start_state").isin(START_STATE, CONVERSION_STATE, NULL_STATE)).select("start_state").distinct()
    channels = sorted(r.start_state for r in names.collect())
    numbered = matrix.sparkSession.createDataFrame(list(zip(channels, range(len(channels)))), "channel string, number long")

    def number(df: DataFrame, state: str, out: str):
        of = numbered.select(F.col("channel").alias(state), F.col("number").alias("_n"))
        fixed = F.when(F.col(state) == START_STATE, -1).when(F.col(state) == CONVERSION_STATE, -2).otherwise(-3)
        return df.join(of, state, "left").select(
            *[c for c in df.columns if c != state], F.coalesce("_n", fixed.cast("long")).alias(out)
        )

    edges = matrix.where(~F.col("start_state").isin(CONVERSION_STATE, NULL_STATE)).select(
        "start_state", "end_state", F.col("transition_probability").alias("p")
    )
    return numbered, len(channels), number(number(edges, "start_state", "i"), "end_state", "j").select("i", "j", "p")


def dense(edges: pa.Table, states: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Rows of the states; the last of a chain's panels ends with Start's."""
    out = np.zeros((len(states), len(columns) + EXTRA))
    i, j = edges.column("i").to_numpy(), edges.column("j").to_numpy()
    row = np.where(i >= 0, np.searchsorted(states[states >= 0], i), len(states) - 1)
    column = np.where(j >= 0, np.searchsorted(columns, j), len(columns) - j - 1)
    np.add.at(out, (row, column), edges.column("p").to_numpy())
    return out


def panel_row(node: int, panel: int, states: np.ndarray, columns: np.ndarray, data: np.ndarray) -> dict[str, pa.Array]:
    numbers = pa.list_(pa.int64())
    return {
        "node": pa.array([node]), "panel": pa.array([panel]), "states": pa.array([states], numbers),
        "columns": pa.array([columns], numbers), "data": pa.array([data.tobytes()]),
    }


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    states, columns = np.array(row["states"], np.int64), np.array(row["columns"], np.int64)
    return states, columns, np.frombuffer(row["data"]).reshape(len(states), -1).copy()


def to_panels(edges: DataFrame, n: int) -> DataFrame:
    """Dense panels of the whole chain, node 1; Start's row is a panel of its own if there are several."""
    several = n > LOCAL_STATES

    def build(key: tuple, table: pa.Table) -> pa.Table:
        panel = key[0].as_py()
        states = np.arange(panel * PANEL, min(n, (panel + 1) * PANEL)) if several else np.arange(n)
        if panel < 0:
            states = np.array([-1])
        elif not several:
            states = np.append(states, -1)
        columns = np.arange(n)
        return pa.table(panel_row(1, panel, states, columns, dense(table, states, columns)))

    of = F.when(F.col("i") < 0, -1).otherwise(F.floor(F.col("i") / PANEL)) if several else F.lit(0)
    return edges.withColumn("panel", of.cast("long")).groupBy("panel").applyInArrow(build, PANELS)


def halve(panels: DataFrame, sizes: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """Two chains from each, with one half of its channels taken out, panel by panel; sizes are in panels."""
    spark = panels.sparkSession
    plan = {}  # node: (parent, panels to take out)
    for node, n in sizes.items():
        half = n // 2
        plan[2 * node], plan[2 * node + 1] = (node, range(half, n)), (node, range(half))
    children = spark.createDataFrame([(c, p) for c, (p, _) in plan.items()], "child long, node long")
    now = panels.join(F.broadcast(children), "node").select(F.col("child").alias("node"), "panel", "states", "columns", "data")
    for step in range(max(len(out) for _, out in plan.values())):
        pivots = [(c, out[step]) for c, (_, out) in plan.items() if step < len(out)]
        chosen = spark.createDataFrame(pivots, "node long, pivot long")
        marked = now.join(F.broadcast(chosen), "node", "left")
        rest = marked.where(F.col("pivot").isNull() | (F.col("panel") != F.col("pivot"))).drop("pivot")
        # the pivot panel goes to each other panel of its chain, under that panel's key
        exits = marked.where(F.col("panel") == F.col("pivot")).drop("pivot").mapInArrow(_exits, "node long, at array<long>, exits binary")
        sent = rest.select("node", "panel").join(exits, "node")
        now = rest.join(sent, ["node", "panel"], "left").mapInArrow(_pass_on, PANELS).checkpoint()
    kept = {c: sizes[p] - len(out) for c, (p, out) in plan.items()}
    return now.mapInArrow(_compact, PANELS).checkpoint(), kept


def _exits(batches):
    for batch in batches:
        for row in batch.to_pylist():
            states, columns, data = unpacked(row)
            at = np.searchsorted(columns, states)
            yield pa.RecordBatch.from_pydict({"node": [row["node"]], "at": [at.tolist()], "exits": [shares_of_exit(data, at).tobytes()]})


def _pass_on(batches):
    for batch in batches:
        for row in batch.to_pylist():
            states, columns, data = unpacked(row)
            if row["exits"] is not None:
                at = np.array(row["at"])
                take_out(data, at, np.frombuffer(row["exits"]).reshape(len(at), -1))
                own = np.flatnonzero(states >= 0)
                data[own, np.searchsorted(columns, states[own])] = 0
            yield pa.RecordBatch.from_pydict(panel_row(row["node"], row["panel"], states, columns, data))


def _compact(batches):
    """Panels without the columns of channels that were taken out; panels are numbered anew, Start's stays."""
    for batch in batches:
        for row in batch.to_pylist():
            states, columns, data = unpacked(row)
            n = -(-len(columns) // PANEL)
            half = n // 2 * PANEL
            low = row["node"] % 2 == 0  # the first half stays
            use = np.arange(half) if low else np.arange(half, len(columns))
            panel = row["panel"] if low or row["panel"] < 0 else row["panel"] - n // 2
            data = data[:, np.concatenate([use, len(columns) + np.arange(EXTRA)])]
            yield pa.RecordBatch.from_pydict(panel_row(row["node"], panel, states, columns[use], data))


def finish(panels: DataFrame, several: bool) -> DataFrame:
    """number and probability of every channel of every chain; a chain may have several panels."""

    def solve(rows: list[dict]) -> dict[str, pa.Array]:
        parts = [unpacked(r) for r in sorted(rows, key=lambda r: r["panel"] if r["panel"] >= 0 else 1 << 62)]
        columns, chain = parts[0][1], np.concatenate([p[2] for p in parts])
        if parts[-1][0][-1] != -1:
            chain = np.concatenate([chain, np.zeros((1, chain.shape[1]))])  # nothing leaves Start
        np.fill_diagonal(chain[:, : len(columns)], 0)
        found = list(full_and_each(chain, columns, rows[0]["node"] & (rows[0]["node"] - 1) == 0))
        return {"number": pa.array([c for c, _ in found], pa.int64()), "p": pa.array([p for _, p in found], pa.float64())}

    def each(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pydict(solve([row]))

    schema = "number long, p double"
    if not several:
        return panels.mapInArrow(each, schema)
    return panels.groupBy("node").applyInArrow(lambda table: pa.table(solve(table.to_pylist())), schema)


def absorbing_probability(matrix: DataFrame, removed: str, probability: str) -> DataFrame:
    """``removed`` (NULL: the full graph, and every channel) and the ``probability`` of conversion from Start.

    Probabilities of a state need not sum to one: only their proportions
    count. Mass that can't reach Conversion is lost. A matrix without rows gives none.
    """
    checkpoint_root(matrix.sparkSession)
    matrix = matrix.select("start_state", "end_state", "transition_probability").checkpoint()
    numbered, n, edges = numbered_edges(matrix)
    panels = to_panels(edges, n)
    sizes = {1: -(-n // PANEL)}
    while n > LOCAL_STATES and max(sizes.values()) * PANEL > LOCAL_STATES:
        large = {k: s for k, s in sizes.items() if s * PANEL > LOCAL_STATES}
        small = panels.where(~F.col("node").isin(list(large)))
        halves, kept = halve(panels.where(F.col("node").isin(list(large))), large)
        panels = small.unionByName(halves)
        sizes = {k: s for k, s in sizes.items() if k not in large} | kept
    found = finish(panels, n > LOCAL_STATES)
    return found.join(numbered, "number", "left").select(F.col("channel").alias(removed), F.col("p").alias(probability))
