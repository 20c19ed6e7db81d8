"""Near-duplicate documents: a Jaccard join of five-word shingle sets along chosen paths.

Texts with equal shingle sets are one class from the start. In every run a set
picks each of its shingles with probability 1 / (0.8 * size), by a hash, and so
enters a bucket for each picked shingle; two similar sets pick a common one
with a probability that doesn't depend on their size. Buckets with more than
BUCKET_SETS sets are split again by shingles picked at the next level. Inside a
bucket all sets are compared by 256-bit sketches, with a margin under the
threshold; a bucket gives no pairs, but each set's link to a hub of those that
look alike. Runs are repeated, RUNS times, so that pairs at the threshold are
missed with a probability under 0.1 %. Buckets that are still large after the
last level are compared in blocks.

The components of these links hold every candidate pair. In each, blocks of
sets are compared exactly, on their whole shingle sets, giving each set the
number of its links and a hub; the components of exact links are the groups.
No list of pairs is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditpath.llm.common import batch_slices, cut
from creditpath.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RUNS = 16
LEVELS = 3
#: Sets in a bucket that are compared at once.
BUCKET_SETS = 512
#: Sets in a block of a component that are compared exactly at once.
BLOCK_SETS = 256
SKETCH_BITS = 256
#: Differing bits up to which sets are compared exactly: 4.6 standard deviations over the mean at the threshold.
SKETCH_DIFFER = 48
#: Sets of at least this many shingles are sketched by 4 permutations of 64 bins.
BINNED_SIZE = 256
BIN_BITS, BINNINGS = 6, 4
#: Shingles whose columns are multiplied at once.
COLUMNS = 1 << 13

_RANDOM = np.random.default_rng(20)
_odd = lambda n: _RANDOM.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WORD_BASE, WORD_SIZE, *_PLACES = _odd(2 + SHINGLE_WORDS)
PLACES = np.array(_PLACES)
PICK = _odd(RUNS * LEVELS)
PERMUTE = _odd(SKETCH_BITS)
KEYS = _odd(2)
BIT = _odd(1)[0]
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, in order, and the text it is in."""
    coded = [t.encode() for t in texts]
    data = np.frombuffer(b" ".join([*coded, b""]), np.uint8)
    blank = SPACES[data]
    word = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(data) else np.zeros(0, np.int64)
    end = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1 if len(data) else word
    power = np.full(len(data) + 1, WORD_BASE)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
    back = np.full(len(data) + 1, np.uint64(pow(int(WORD_BASE), -1, 1 << 64)))
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    hashed = _mix((total[end] - total[word]) * back[word] + (end - word).astype(np.uint64) * WORD_SIZE)
    begin = np.cumsum([0, *(len(c) + 1 for c in coded)])
    return hashed, np.searchsorted(begin, word, side="right") - 1


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, concatenated, and their number.

    A text of one to four words has them all as its only shingle; one without
    words has none.
    """
    word, of = word_hashes(texts)
    n_words = np.bincount(of, minlength=len(texts))
    n = max(0, len(word) - SHINGLE_WORDS + 1)
    hashed = np.zeros(n, np.uint64)
    for k in range(SHINGLE_WORDS):
        hashed += word[k : k + n] * PLACES[k]
    inside = of[:n] == of[SHINGLE_WORDS - 1 :][:n]
    hashed, owner = _mix(hashed[inside]), of[:n][inside]
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE_WORDS))
    if len(short):
        first = (np.cumsum(n_words) - n_words)[short]
        few = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE_WORDS - 1):
            there = n_words[short] > k
            few[there] += word[first[there] + k] * PLACES[k]
        hashed = np.concatenate([hashed, _mix(few + n_words[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    return hashed[new], np.bincount(owner[new], minlength=len(texts))


def _sketch_bits(shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One-bit minima under SKETCH_BITS permutations; a row of bits for each set, all of them non-empty."""
    begin = np.cumsum(count) - count
    bits = np.zeros((len(count), SKETCH_BITS), np.uint8)
    for j in range(SKETCH_BITS):
        low = np.minimum.reduceat(shingle * PERMUTE[j], begin)
        bits[:, j] = _mix(low ^ BIT) >> np.uint64(63)
    return bits


def _binned_bits(shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The same from a few permutations, each cut into bins with a minimum of its own."""
    n, bins = len(count), 1 << BIN_BITS
    owner = np.repeat(np.arange(n), count)
    out = []
    empty = np.uint64(2**64 - 1)
    for j in range(BINNINGS):
        h = shingle * PERMUTE[j]
        low = np.full(n * bins, empty)
        np.minimum.at(low, owner * bins + (h >> np.uint64(64 - BIN_BITS)).astype(np.int64), h)
        low = low.reshape(n, bins)
        for _ in range(bins):  # an empty bin takes its neighbour's minimum
            void = low == empty
            if not void.any():
                break
            low = np.where(void, np.roll(low, -1, axis=1), low)
        out.append((_mix(low ^ BIT) >> np.uint64(63)).astype(np.uint8))
    return np.concatenate(out, 1)


def sketches(shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Packed sketch of each set; zeros for an empty one."""
    out = np.zeros((len(count), SKETCH_BITS // 8), np.uint8)
    owner = np.repeat(np.arange(len(count)), count)
    for rows, make in (
        (np.flatnonzero((count > 0) & (count < BINNED_SIZE)), _sketch_bits),
        (np.flatnonzero(count >= BINNED_SIZE), _binned_bits),
    ):
        if len(rows):
            chosen = np.zeros(len(count), bool)
            chosen[rows] = True
            out[rows] = np.packbits(make(shingle[chosen[owner]], count[rows]), axis=1)
    return out


def picked(shingle: np.ndarray, count: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each run and level, the picked shingles and the sets they are of."""
    owner = np.repeat(np.arange(len(count)), count)
    most = np.repeat(np.minimum(2.0**64 / (SIMILARITY * np.maximum(count, 1)), 2.0**64 - 2048).astype(np.uint64), count)
    out = []
    for seed in PICK:
        at = np.flatnonzero(shingle * seed <= most)
        out.append((owner[at], shingle[at]))
    return out


def text_hash() -> Column:
    """What finds a text that no id names."""
    return F.xxhash64("text")


def describe_sets(docs: DataFrame) -> DataFrame:
    """doc_id, at (a hash of the text), key (16 bytes; null without words), size, sketch and the picks of every run and level."""

    def run(batches):
        for batch in batches:
            ids, at = batch.column("doc_id"), batch.column("at")
            for a, b, texts in batch_slices(batch):
                shingle, count = shingle_sets(texts)
                n = b - a
                sketch = sketches(shingle, count)
                owners, values, places = [], [], []
                for place, (owner, value) in enumerate(picked(shingle, count)):
                    owners.append(owner)
                    values.append(value)
                    places.append(np.full(len(owner), place))
                owner, value, place = (np.concatenate(x) for x in (owners, values, places))
                # a list of RUNS * LEVELS lists for each set
                cell = owner * (RUNS * LEVELS) + place
                order = np.argsort(cell, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(cell, minlength=n * RUNS * LEVELS))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value[order].view(np.int64)))
                picks = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * RUNS * LEVELS, pa.int32()), lists)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[a:b],
                        at[a:b],
                        _keys(shingle, count),
                        pa.array(count, pa.int64()),
                        pa.array([s.tobytes() for s in sketch], pa.binary()),
                        picks,
                    ],
                    names=["doc_id", "at", "key", "size", "sketch", "picks"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("at"), "text")
    return rows.mapInArrow(run, "doc_id long, at long, key binary, size long, sketch binary, picks array<array<long>>")


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def _hubs(alike: np.ndarray) -> np.ndarray:
    """The smallest row that each row is connected to, for a symmetric matrix."""
    n = len(alike)
    hub = np.arange(n)
    while True:
        near = np.minimum(hub, np.where(alike, hub[None, :], n).min(1))
        near = near[near]
        if (near == hub).all():
            return hub
        hub = near


def _alike(sketch_a, size_a, sketch_b, size_b) -> np.ndarray:
    """Which sets may be similar: their sketches and their sizes allow it."""
    close = _differ(sketch_a[..., :, None, :], sketch_b[..., None, :, :]) <= SKETCH_DIFFER
    a, b = size_a[..., :, None], size_b[..., None, :]
    return close & (np.minimum(a, b) >= SIMILARITY * np.maximum(a, b))


def _bucket_links(path: np.ndarray, key: np.ndarray, sketch: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows linked with their bucket's hubs; rows come sorted by path."""
    begin = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
    count = np.diff(np.append(begin, len(path)))
    for m in np.unique(count[count > 1]):
        first = begin[count == m]
        step = max(1, (1 << 18) // (m * m))
        for k in range(0, len(first), step):
            rows = first[k : k + step, None] + np.arange(m)
            alike = _alike(sketch[rows], size[rows], sketch[rows], size[rows])
            for i in np.flatnonzero(alike.sum((1, 2)) > m):  # more than each row with itself
                hub = _hubs(alike[i])
                far = np.flatnonzero(hub != np.arange(m))
                yield rows[i, far], rows[i, hub[far]]


_LINKS = "a binary, b binary"


def _link_batch(key: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    columns = [pa.array(key[np.concatenate(x)] if x else [], pa.binary()) for x in (a, b)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _sketch_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    path, size = batch.column("path").to_numpy(), batch.column("size").to_numpy()
    key = np.array(batch.column("key").to_pylist(), object)
    sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64).reshape(len(path), -1)
    return path, key, sketch, size


def link_small_buckets(rows: DataFrame) -> DataFrame:
    """Links inside buckets of at most BUCKET_SETS rows (path, key, sketch, size)."""

    def run(batches):
        held = None
        for batch in batches:
            now = _sketch_rows(batch)
            now = now if held is None else tuple(np.concatenate([h, x]) for h, x in zip(held, now))
            last = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            held = tuple(x[last:] for x in now)  # the last bucket may go on in the next batch
            found = list(_bucket_links(*(x[:last] for x in now)))
            yield _link_batch(now[1], [a for a, _ in found], [b for _, b in found])
        if held is not None and len(held[0]):
            found = list(_bucket_links(*held))
            yield _link_batch(held[1], [a for a, _ in found], [b for _, b in found])

    return rows.repartition("path").sortWithinPartitions("path").mapInArrow(run, _LINKS)


def link_large_buckets(rows: DataFrame) -> DataFrame:
    """Links inside buckets of any size: each block of sets meets each other block in a task of its own."""
    blocks = F.ceil(F.col("n") / BUCKET_SETS).cast("int")
    own = F.pmod(F.xxhash64("key"), blocks).cast("int")
    pairs = rows.select(
        "path", "key", "sketch", "size", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    ).select("path", "key", "sketch", "size", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def run(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        _, key, sketch, size = _sketch_rows(batch)
        hub = _hubs(_alike(sketch, size, sketch, size))
        far = np.flatnonzero(hub != np.arange(len(hub)))
        return pa.Table.from_batches([_link_batch(key, [far], [hub[far]])])

    return pairs.groupBy("path", "i", "j").applyInArrow(run, _LINKS)


def candidate_links(sets: DataFrame) -> DataFrame:
    """Links (a, b) whose components hold every pair of sets that met in a bucket and looks alike.

    ``sets`` has a row per distinct key: key, size, sketch, picks.
    """
    describe = sets.select("key", "size", "sketch")
    runs = F.explode(F.array(*[F.lit(r) for r in range(RUNS)])).alias("run")
    level0 = sets.select("key", runs, "picks").select(
        "key", "run", F.explode(F.get("picks", F.col("run") * LEVELS)).alias("pick")
    )
    rows = level0.select("key", "run", F.xxhash64("run", "pick").alias("path"))
    links = []
    for level in range(LEVELS):
        rows = cut(rows)
        counts = rows.groupBy("path").agg(F.count("*").alias("n")).where(F.col("n") > 1)
        met = cut(rows.join(counts, "path"))
        small = met.where(F.col("n") <= BUCKET_SETS).join(describe, "key").select("path", "key", "sketch", "size")
        links.append(cut(link_small_buckets(small).distinct()))
        large = met.where(F.col("n") > BUCKET_SETS)
        if large.isEmpty():
            break
        if level + 1 == LEVELS:
            links.append(cut(link_large_buckets(large.join(describe, "key")).distinct()))
            break
        deeper = large.join(sets.select("key", "picks"), "key").select(
            "key", "run", "path", F.explode(F.get("picks", F.col("run") * LEVELS + (level + 1))).alias("pick")
        )
        rows = deeper.select("key", "run", F.xxhash64("path", "pick").alias("path"))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def _similar(a: list[np.ndarray], b: list[np.ndarray], alike: np.ndarray) -> np.ndarray:
    """Exact test of the pairs that look alike: shared shingles are counted by products of 0/1 matrices."""
    flat = np.concatenate([*a, *b])
    size = np.array([len(x) for x in (*a, *b)])
    owner = np.repeat(np.arange(len(size)), size)
    name, which, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1  # others are in one set only
    column = np.cumsum(shared) - 1
    keep = shared[which]
    owner, column = owner[keep], column[which[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(a), len(b)), np.float32)
    for low in range(0, int(shared.sum()), COLUMNS):
        i, j = np.searchsorted(column, [low, low + COLUMNS])
        there = np.zeros((len(size), COLUMNS), np.float32)
        there[owner[i:j], column[i:j] - low] = 1
        common += there[: len(a)] @ there[len(a) :].T
    union = size[: len(a), None] + size[None, len(a) :] - common
    return alike & (common >= SIMILARITY * union - 1e-6 * union)


def exact_links(members: DataFrame) -> DataFrame:
    """key, hub and linked documents for every set and block pair of its component.

    ``members``: root, key, n (documents of the class), n_sets (of the
    component), sketch, shingles.
    """
    blocks = F.ceil(F.col("n_sets") / BLOCK_SETS).cast("int")
    own = F.pmod(F.xxhash64("key"), blocks).cast("int")
    pairs = members.select(
        "root", "key", "n", "sketch", "shingles", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    ).select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def run(table: pa.Table) -> pa.Table:
        key = table.column("key").to_pylist()
        n = table.column("n").to_numpy()
        block, i, j = table.column("own").to_numpy(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(key), -1)
        sets = [np.asarray(x.values) for x in table.column("shingles")]
        size = np.array([len(s) for s in sets])
        alike = _alike(sketch, size, sketch, size)
        if i != j:
            alike &= block[:, None] != block[None, :]
        np.fill_diagonal(alike, False)
        link = _similar(sets, sets, alike) if alike.any() else alike
        hub = _hubs(link)
        return pa.table(
            [pa.array(key, pa.binary()), pa.array([key[h] for h in hub], pa.binary()), pa.array((link * n[None, :]).sum(1), pa.int64())],
            names=["key", "hub", "linked"],
        )

    return pairs.groupBy("root", "i", "j").applyInArrow(run, "key binary, hub binary, linked long")


def shingles_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key and shingles of the wanted sets (doc_id, at, key), from one document of each: by its id, or its text's hash without one."""

    def run(batches):
        for batch in batches:
            keys = batch.column("key")
            for a, b, texts in batch_slices(batch):
                shingle, count = shingle_sets(texts)
                ends = np.concatenate([[0], np.cumsum(count)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(shingle.view(np.int64)))
                yield pa.RecordBatch.from_arrays([keys[a:b], lists, _keys(shingle, count)], names=["key", "shingles", "own"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = rows.join(wanted.where("doc_id is not null").select("doc_id", "key"), "doc_id").select("key", "text")
    nameless = rows.where("doc_id is null").withColumn("at", text_hash())
    lost = wanted.where("doc_id is null").select("at", "key")
    found = named.unionByName(nameless.join(lost, "at").select("key", "text").dropDuplicates(["key"]))
    found = found.mapInArrow(run, "key binary, shingles array<long>, own binary")
    # an id may stand on several texts: only the one with this key counts
    return found.where("own = key").dropDuplicates(["key"]).select("key", "shingles")


def _keys(shingle: np.ndarray, count: np.ndarray) -> pa.Array:
    """16 bytes that name each set; null for an empty one."""
    some = count > 0
    key = np.zeros((len(count), 2), np.uint64)
    if some.any():
        begin = (np.cumsum(count) - count)[some]
        for k in range(2):
            key[some, k] = _mix(np.add.reduceat(_mix(shingle * KEYS[k]), begin) + count[some].astype(np.uint64))
    return pa.array([k.tobytes() if s else None for k, s in zip(key, some)], pa.binary())


def grouped_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``near_duplicates`` with at, the hash of the row's text, and root, one name for all of a group; null without words."""
    described = cut(describe_sets(docs))
    sets = (
        described.where("key is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("first"), F.min("at").alias("at"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("sketch").alias("sketch"), F.first("picks").alias("picks"))
    )
    sets = cut(sets)
    links = candidate_links(sets.select("key", "size", "sketch", "picks"))
    roots = cut(components(links).withColumnRenamed("node", "key"))
    sizes = roots.groupBy("root").agg(F.count("*").alias("n_sets"))
    wanted = cut(roots.join(sizes, "root").join(sets.select("key", "first", "at", "n", "sketch"), "key"))
    shingles = shingles_of(docs, wanted.select(F.col("first").alias("doc_id"), "at", "key"))
    exact = cut(exact_links(wanted.join(shingles, "key")))
    groups = components(exact.select(F.col("key").alias("a"), F.col("hub").alias("b")))
    linked = exact.groupBy("key").agg(F.sum("linked").alias("linked"))
    grouped = groups.withColumnRenamed("node", "key").join(sets.select("key", "first"), "key")
    smallest = grouped.groupBy("root").agg(F.min("first").alias("class_id"))
    classes = grouped.join(smallest, "root").select("key", "root", "class_id")
    of_set = (
        sets.select("key", "first", "n")
        .join(classes, "key", "left")
        .join(linked, "key", "left")
        .select(
            "key",
            F.coalesce("root", "key").alias("root"),
            F.coalesce("class_id", "first").alias("class_id"),
            F.col("n").alias("n_copies"),
            (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    rows = described.select("doc_id", "at", "key")
    return (
        rows.join(of_set, "key", "left")
        .select(
            "doc_id",
            F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "at",
            "root",
        )
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_copies and n_links for every row (doc_id, text; other columns aren't read).

    class_id is the smallest doc_id of the group that links of a similarity of
    0.8 or more connect; n_copies counts the rows with the same set of
    shingles, n_links the other rows within the threshold, copies included.
    Words are what white space separates; case and signs count. A text without
    words, or null, is alone: its class is its own id, its counts are 1 and 0.
    Repeated rows are copies of each other. Null ids are never a class unless
    all of a group's are null.
    """
    return grouped_rows(docs).drop("at", "root")
