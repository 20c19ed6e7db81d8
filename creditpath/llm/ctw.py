"""Language-model scores by context-tree weighting over bytes.

A byte is coded as eight binary decisions. Each decision, named by the bits
before it in its byte, has a context tree of its own over the preceding bytes.
A node's Krichevsky-Trofimov estimate codes the decisions made in its context,
and its weighted probability is half that of its own estimate and half the
product of its children's, so that all depths are mixed. With the counts
frozen after training, the mix along a context's path is one number a node.

Every context that the training corpus holds is in the tree, however rare, so
the model grows with the corpus and is nowhere held whole. Every task counts
the byte grams of its texts, and Spark adds them up. The distinct grams, sorted
by their contexts from the newest byte on, are dealt in ranges over tasks. A
task weighs all contexts that lie in its range; the few that a range's bound
cuts ("open": at most DEPTH for each bound) are put together on the driver from
every task's sums. The grams seen most, a bounded number, travel to the texts
with their probabilities. Any other gram of a text, seen or not, goes to the
task that holds its contexts and is looked up in the whole tree there.

The text that is scored is its lower-case words, each followed by a blank, and
a line feed for the end. Code lengths are thus those of the same tokens that
the base model scores, a word-count model with additive smoothing.
"""

from __future__ import annotations

import math
from collections import Counter as Bag
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditpath.llm.common import Shared, batch_slices, cut, set_aside
from creditpath.llm.grams import Cache, Counter, windows

#: Bytes of context.
DEPTH = 5
#: Distinct grams, the deepest nodes, whose trees one task weighs: about this many.
NODES = 1 << 15
#: Grams that travel to every task with their probabilities: at most this many.
GRAMS = 1 << 21
#: Words with at least 1/WORDS of the training tokens travel to every task: at most WORDS of them.
WORDS = 1 << 18
SMOOTHING = 0.1
#: Distinct words that a task holds before it passes their counts on.
BAG_WORDS = 1 << 18

#: Columns that scoring replaces or doesn't pass on.
ADDED = ["text", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]

BLANK, END = b" ", b"\n"
#: Byte before the first of a text, DEPTH times.
PAD = 0x0A


def words_of(text: str | None) -> list[bytes]:
    """Lower-case (A-Z) words between space and tab to carriage return."""
    return (text or "").encode().lower().split()


def byte_grams(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of DEPTH + 1 bytes at every scored byte, and the number of these in each text."""
    coded = [BLANK.join([*w, END]) for w in words]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    pad = bytes([PAD]) * DEPTH
    data = np.frombuffer(pad + pad.join(coded), np.uint8)
    at = np.arange(int(sizes.sum())) + DEPTH * (np.repeat(np.arange(len(coded)), sizes) + 1)
    return windows(data, DEPTH + 1)[at], sizes


def ordered(grams: np.ndarray) -> np.ndarray:
    """Grams with the context's bytes turned round, the newest highest: keys with a common end of their contexts lie together."""
    key = grams & 255
    for k in range(1, DEPTH + 1):
        key = key | (grams >> 8 * k & 255) << 8 * (DEPTH + 1 - k)
    return key


def count_grams(docs: DataFrame) -> DataFrame:
    """key (a gram as ``ordered``) and count over all texts."""

    def run(batches):
        counter = Counter(20)
        for batch in batches:
            for _, _, texts in batch_slices(batch):
                counter.add(byte_grams([words_of(t) for t in texts])[0])
        gram, n = counter.result()
        for k in range(0, len(gram), 1 << 20):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ordered(gram[k : k + (1 << 20)])), pa.array(n[k : k + (1 << 20)])], names=["key", "n"]
            )

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def count_words(docs: DataFrame) -> DataFrame:
    """word and count over all texts, the ends not included."""

    def run(batches):
        bag: Bag = Bag()
        for batch in batches:
            for _, _, texts in batch_slices(batch):
                for text in texts:
                    bag.update(words_of(text))
                if len(bag) > BAG_WORDS:
                    yield _bag_rows(bag)
                    bag = Bag()
        yield _bag_rows(bag)

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _bag_rows(bag: Bag) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(bag.keys()), pa.binary()), pa.array(list(bag.values()), pa.int64())], names=["word", "n"]
    )


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series after shifting the argument up; good to 1e-10 for x >= 0.5."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


#: log gamma of k + 1/2 and of k + 1, for small counts k.
SMALL = 1 << 12
LOG_GAMMA = {0.5: _log_gamma(np.arange(SMALL) + 0.5), 1.0: _log_gamma(np.arange(SMALL) + 1.0)}


def _log_gamma_from(k: np.ndarray, more: float) -> np.ndarray:
    out = LOG_GAMMA[more][np.minimum(k, SMALL - 1)]
    big = k >= SMALL
    if big.any():
        out[big] = _log_gamma(k[big] + more)
    return out


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _log_gamma_from(a, 0.5) + _log_gamma_from(b, 0.5) - _log_gamma_from(a + b, 1.0) - math.log(math.pi)


def _mix(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log of the weighted probability of nodes with children, and the share of the node's own estimate in it."""
    weighted = np.logaddexp(own, below) - math.log(2)
    return weighted, np.exp(own - math.log(2) - weighted)


def _one(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (b + 0.5) / (a + b + 1.0)


def open_contexts(bounds: np.ndarray) -> list[np.ndarray]:
    """By depth the contexts whose range has a bound inside, and the empty one."""
    out = [np.zeros(1, np.int64)]
    for d in range(1, DEPTH + 1):
        below = 8 * (DEPTH - d)
        out.append(np.unique(bounds[bounds & ((1 << below) - 1) != 0] >> below))
    return out


@dataclass
class Nodes:
    """Nodes of one bit and depth, named by context and bits of the byte so far, sorted by name."""

    name: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    parent: np.ndarray
    open: np.ndarray


@dataclass
class Top:
    """Open nodes of one bit and depth: probability of a one where a path ends there, and what their children start from."""

    name: np.ndarray
    ends: np.ndarray
    passed: np.ndarray
    remains: np.ndarray


class Part:
    """The trees over the training grams of one range of contexts."""

    def __init__(self, key: np.ndarray, n: np.ndarray, bounds: np.ndarray):
        order = np.argsort(key)
        self.open = open_contexts(bounds)
        self.at, self.n, self.up = [key[order]], [n[order]], []
        for _ in range(DEPTH):
            shorter, up = np.unique(self.at[0] >> 16 << 8 | self.at[0] & 255, return_inverse=True)
            self.n.insert(0, np.bincount(up, self.n[0], len(shorter)).astype(np.int64))
            self.at.insert(0, shorter)
            self.up.insert(0, up)

    def nodes(self, bit: int) -> list[Nodes]:
        """By depth the nodes with the decisions made there, and where their parents stand."""
        out: list[Nodes] = []
        above = np.zeros(0, np.int64)
        for d in range(DEPTH + 1):
            at, n = self.at[d], self.n[d]
            name = at >> (8 - bit)
            new = np.ones(len(name), bool)
            new[1:] = name[1:] != name[:-1]
            first = np.flatnonzero(new)
            seen = np.add.reduceat(n, first) if len(first) else n
            ones = np.add.reduceat(n * (at >> (7 - bit) & 1), first) if len(first) else n
            parent = above[self.up[d - 1][first]] if d else np.zeros(len(first), np.int64)
            name = name[first]
            out.append(Nodes(name, seen - ones, ones, parent, np.isin(name >> bit, self.open[d])))
            above = np.cumsum(new) - 1
        return out

    @staticmethod
    def weigh(nodes: list[Nodes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """By depth the sum of the closed children's log weighted probabilities, and the share of a node's own estimate.

        Both are whole for closed nodes only.
        """
        out = []
        weighted = np.zeros(0)
        for d in range(DEPTH, -1, -1):
            x = nodes[d]
            own = _log_kt(x.zeros, x.ones)
            if d == DEPTH:
                weighted, below, stop = own, own, np.ones(len(own))
            else:
                child = nodes[d + 1]
                below = np.bincount(child.parent, np.where(child.open, 0.0, weighted), len(own))
                weighted, stop = _mix(own, below)
            out.insert(0, (below, stop))
        return out

    def open_sums(self) -> list[np.ndarray]:
        """depth, bit, name, zeros, ones and closed children's weights of the open nodes, as far as they lie here."""
        rows: list[list[np.ndarray]] = []
        for bit in range(8):
            nodes = self.nodes(bit)
            for d, (x, (below, _)) in enumerate(zip(nodes, self.weigh(nodes))):
                k = x.open
                rows.append([np.full(k.sum(), d), np.full(k.sum(), bit), x.name[k], x.zeros[k], x.ones[k], below[k]])
        return [np.concatenate(c) for c in zip(*rows)]

    def finish(self, top: dict[tuple[int, int], Top]) -> Part:
        """Mixes along every path from the root down, where the open nodes are known."""
        self.top = top
        self.ends: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for bit in range(8):
            nodes = self.nodes(bit)
            passed = remains = np.zeros(0)
            for d, (x, (_, stop)) in enumerate(zip(nodes, self.weigh(nodes))):
                # the root is open, so what it starts from is overwritten
                so_far, left = (passed[x.parent], remains[x.parent]) if d else (np.zeros(len(x.name)), np.ones(len(x.name)))
                one = _one(x.zeros, x.ones)
                ends, passed, remains = so_far + left * one, so_far + left * stop * one, left * (1 - stop)
                if x.open.any():
                    t = top[d, bit]
                    at = np.searchsorted(t.name, x.name[x.open])
                    ends[x.open], passed[x.open], remains[x.open] = t.ends[at], t.passed[at], t.remains[at]
                self.ends[d, bit] = x.name, ends
        return self

    def log10(self, key: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each gram, whose context lies in the part's range."""
        byte = key & 255
        out = np.zeros(len(key))
        for bit in range(8):
            p = np.full(len(key), 0.5)
            left = np.arange(len(key))
            for d in range(DEPTH, -1, -1):
                t = self.top.get((d, bit))
                # an open context may have been seen in other parts only
                for name, ends in [self.ends[d, bit], *([(t.name, t.ends)] if t else [])]:
                    if not len(name) or not len(left):
                        continue
                    want = (key[left] >> 8 * (DEPTH + 1 - d) << 8 | byte[left]) >> (8 - bit)
                    at = np.minimum(np.searchsorted(name, want), len(name) - 1)
                    hit = name[at] == want
                    p[left[hit]] = ends[at[hit]]
                    left = left[~hit]
            out += np.log10(np.where(byte >> (7 - bit) & 1, p, 1 - p))
        return out


def join_open(rows: dict[str, np.ndarray]) -> dict[tuple[int, int], Top]:
    """The open nodes from the sums of all parts: weights from the deepest up, then the mix from the root down."""
    out: dict[tuple[int, int], Top] = {}
    for bit in range(8):
        kept: list[tuple] = []
        child, weighted = np.zeros(0, np.int64), np.zeros(0)
        for d in range(DEPTH - 1, -1, -1):
            mine = (rows["depth"] == d) & (rows["bit"] == bit)
            name, which = np.unique(rows["name"][mine], return_inverse=True)
            a, b, below = (np.bincount(which, rows[c][mine], len(name)) for c in ("zeros", "ones", "below"))
            a, b = a.astype(np.int64), b.astype(np.int64)
            parent = np.searchsorted(name, child >> (8 + bit) << bit | child & ((1 << bit) - 1))
            below = below + np.bincount(parent, weighted, len(name))
            weighted, stop = _mix(_log_kt(a, b), below)
            kept.append((name, _one(a, b), stop, parent))
            child = name
        so_far, left = np.zeros(len(child)), np.ones(len(child))
        for d, (name, one, stop, parent) in enumerate(reversed(kept)):
            top = Top(name, so_far + left * one, so_far + left * stop * one, left * (1 - stop))
            out[d, bit] = top
            so_far, left = top.passed[parent], top.remains[parent]
    return out


def _gathered(batches) -> tuple[np.ndarray, np.ndarray]:
    """key and n of all rows of batches."""
    got = [(b.column("key").to_numpy(), b.column("n").to_numpy()) for b in batches]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *[k for k, _ in got]]), np.concatenate([none, *[n for _, n in got]])


def _dealt(rows: DataFrame, bounds: np.ndarray) -> DataFrame:
    return rows.repartitionById(len(bounds) + 1, F.col("part"))


@dataclass
class Model:
    """Training grams (part, key, n), one part a partition, the parts' bounds and the open nodes."""

    grams: DataFrame
    bounds: np.ndarray
    top: Shared

    def frequent(self) -> tuple[np.ndarray, np.ndarray]:
        """At most GRAMS grams, those seen most, sorted, and their log10 probabilities."""
        step = F.floor(F.log2("n") * 8)
        least, many = math.inf, 0
        for r in sorted(self.grams.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):  # a few hundred
            many += r["count"]
            if many > GRAMS:
                break
            least = r["step"]
        bounds, top = self.bounds, self.top

        def run(batches):
            rows = list(batches)
            if not rows:
                return
            key, n = _gathered(rows)
            chosen = key[np.concatenate([b.column("chosen").to_numpy(zero_copy_only=False) for b in rows])]
            value = Part(key, n, bounds).finish(top.value).log10(chosen)
            yield pa.RecordBatch.from_arrays([pa.array(ordered(chosen)), pa.array(value, pa.float32())], names=["gram", "value"])

        if least == math.inf:
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        marked = self.grams.withColumn("chosen", step >= least)
        got = marked.mapInArrow(run, "gram long, value float").toArrow()  # at most GRAMS rows
        gram, value = got["gram"].to_numpy(), got["value"].to_numpy()
        order = np.argsort(gram)
        return gram[order], value[order]

    def look_up(self, rows: DataFrame) -> DataFrame:
        """Sums over rows of row, part, key and n (how often): row and score, in several rows each."""
        bounds, top = self.bounds, self.top

        def run(batches):
            seen, part = [], None
            for batch in batches:
                learned = batch.filter(batch.column("row").is_null())
                seen.append(learned.select(["key", "n"]))
                asked = batch.filter(batch.column("row").is_valid())
                if not asked.num_rows:
                    continue
                # the learned grams come first
                if part is None:
                    part = Part(*_gathered(seen), bounds).finish(top.value)
                    seen.clear()
                key, which = np.unique(asked.column("key").to_numpy(), return_inverse=True)
                row, to = np.unique(asked.column("row").to_numpy(), return_inverse=True)
                score = np.bincount(to, part.log10(key)[which] * asked.column("n").to_numpy(), len(row))
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(score)], names=["row", "score"])

        learned = self.grams.select(F.lit(None).cast("long").alias("row"), "part", "key", "n")
        met = _dealt(learned.unionByName(rows), bounds).sortWithinPartitions(F.col("row").isNotNull(), "key")
        return met.mapInArrow(run, "row long, score double")

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last byte after the others, for a few grams."""
        key = ordered(grams)
        rows = pa.table({"row": np.arange(len(key)), "part": part_of(key, self.bounds), "key": key, "n": np.ones(len(key), np.int64)})
        got = self.look_up(self.grams.sparkSession.createDataFrame(rows)).groupBy("row").agg(F.sum("score").alias("score")).collect()
        out = np.zeros(len(key))
        for r in got:
            out[r["row"]] = r["score"]
        return out


def part_of(key: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, key >> 8, "right").astype(np.int32)


def part_bounds(grams: DataFrame) -> np.ndarray:
    """Contexts at which parts of about NODES grams begin, but the first.

    They stand at even steps among some 100 keys a part, taken by hash; where
    they stand decides how even the parts are and nothing else.
    """
    parts = -(-grams.count() // NODES)
    if parts < 2:
        return np.zeros(0, np.int64)
    some = grams.where(F.pmod(F.xxhash64("key"), F.lit(max(1, NODES // 100))) == 0).select("key").toArrow()
    keys = np.sort(some["key"].to_numpy())
    contexts = np.unique(keys[np.arange(1, parts) * len(keys) // parts] >> 8) if len(keys) else keys
    return contexts[contexts > 0]


def learn(docs: DataFrame) -> Model:
    """The model of all texts of ``docs``; without rows every bit has probability 1/2."""
    counted = cut(count_grams(docs))
    bounds = part_bounds(counted)

    def place(batches):
        for batch in batches:
            part = pa.array(part_of(batch.column("key").to_numpy(), bounds))
            yield pa.RecordBatch.from_arrays([part, batch.column("key"), batch.column("n")], names=["part", "key", "n"])

    grams = cut(_dealt(counted.mapInArrow(place, "part int, key long, n long"), bounds))

    def run(batches):
        rows = list(batches)
        if not rows:
            return
        sums = Part(*_gathered(rows), bounds).open_sums()
        part = np.full(len(sums[0]), rows[0].column("part")[0].as_py())
        names = ["part", "depth", "bit", "name", "zeros", "ones", "below"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in [part, *sums]], names=names)

    # at most 255 rows for each bound and depth from either side
    got = grams.mapInArrow(run, "part long, depth long, bit long, name long, zeros long, ones long, below double").toArrow()
    got = got.sort_by([(c, "ascending") for c in ("depth", "bit", "name", "part")])
    top = join_open({c: got[c].to_numpy() for c in got.column_names})
    return Model(grams, bounds, Shared(docs.sparkSession, top))


def _listed(text: np.ndarray, key: np.ndarray, texts: int, bounds: np.ndarray) -> pa.ListArray:
    """For each text its distinct keys with their part and how often they stand there."""
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    offsets = np.searchsorted(text[first], np.arange(texts + 1)).astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array(part_of(key, bounds)), pa.array(key), pa.array(times)], names=["part", "key", "n"])
    return pa.ListArray.from_arrays(pa.array(offsets), rows)


def score_documents(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """Scores every row of ``docs`` (doc_id, text and any other columns but those added).

    Adds n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.
    A null or empty text has its end as the only token. Repeated rows stay,
    each with its scores. Columns of the added names are replaced; all others
    stay, whatever their names.
    """
    return set_aside(docs, {"_n"}, lambda own: _score_documents(own, learn_from))


def _score_documents(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    model = learn(learn_from)
    words = cut(count_words(learn_from))
    totals = words.agg(F.sum("n"), F.count("*")).first()
    ends = learn_from.count()
    n, v = (totals[0] or 0) + ends, totals[1] + (ends > 0)
    cost = n + SMOOTHING * (v + 1)
    frequent = words.where(F.col("n") >= max(1.0, n / WORDS)).collect()  # at most WORDS rows
    spark = docs.sparkSession
    bounds = model.bounds
    shared = Shared(spark, (model.frequent(), {bytes(r["word"]): r["n"] for r in frequent}))

    def log_part(count):
        return math.log10((count + SMOOTHING) / cost)

    def run(batches):
        (known_gram, value), counts = shared.value

        def evaluate(gram):
            """NaN for the grams that aren't here; without training every bit has probability 1/2."""
            if not len(known_gram):
                return np.full((len(gram), 1), np.nan if ends else -8 * math.log10(2))
            at = np.minimum(np.searchsorted(known_gram, gram), len(known_gram) - 1)
            return np.where(known_gram[at] == gram, value[at], np.nan)[:, None]

        logs = {w: log_part(c) for w, c in counts.items()}
        end_log = log_part(ends)
        cache = Cache(evaluate, 1, 21)
        for batch in batches:
            # a batch out for each slice in: the words to look up are many small objects
            for a, b, texts in batch_slices(batch):
                split = [words_of(t) for t in texts]
                gram, size = byte_grams(split)
                known_log = cache(gram)[:, 0]
                absent = np.isnan(known_log)
                # every text has its end, so none is empty here
                score = np.add.reduceat(np.where(absent, 0, known_log), np.cumsum(size) - size, dtype=np.float64)
                grams = _listed(np.repeat(np.arange(len(size)), size)[absent], ordered(gram[absent]), len(size), bounds)
                n_tokens, known, base, rare = [], [], [], []
                for tokens in split:
                    total, found, other = end_log, int(ends > 0), []
                    for w, c in Bag(tokens).items():
                        x = logs.get(w)
                        if x is None:
                            other.append({"word": w, "times": c})
                        else:
                            total += c * x
                            found += c
                    n_tokens.append(len(tokens) + 1)
                    known.append(found)
                    base.append(total)
                    rare.append(other)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_row").slice(a, b - a), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()),
                        pa.array(base, pa.float64()), pa.array(score), pa.array(size, pa.int64()),
                        pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))), grams,
                    ],
                    names=["_row", "n_tokens", "_known", "_base", "score", "_bytes", "_rare", "_grams"],
                )

    own = [c for c in docs.columns if c not in ADDED]
    numbered = docs.select(F.struct(F.monotonically_increasing_id().alias("_n"), *own).alias("_row"), "text")
    added = "n_tokens long, _known long, _base double, score double, _bytes long, _rare array<struct<word:binary,times:bigint>>"
    added += ", _grams array<struct<part:int,key:bigint,n:bigint>>"
    schema = StructType([numbered.schema["_row"], *StructType.fromDDL(added).fields])
    scored = cut(numbered.mapInArrow(run, schema))
    # the other words are looked up by a join; none of them is frequent
    other = scored.select(F.col("_row._n").alias("_n"), F.inline("_rare"))
    part = F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + SMOOTHING) / F.lit(float(cost)))
    found = other.join(words, "word", "left").select(
        "_n", part.alias("_part"), F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("_more"), F.lit(0.0).alias("_score")
    )
    # and so are the other grams, by the tasks that hold their contexts
    mixed = model.look_up(scored.select(F.col("_row._n").alias("row"), F.inline("_grams")))
    mixed = mixed.select(F.col("row").alias("_n"), F.lit(0.0).alias("_part"), F.lit(0).alias("_more"), F.col("score").alias("_score"))
    looked_up = found.unionByName(mixed).groupBy("_n").agg(*[F.sum(c).alias(c) for c in ("_part", "_more", "_score")])
    out = scored.drop("_rare", "_grams").withColumn("_n", F.col("_row._n")).join(looked_up, "_n", "left")
    score = F.col("score") + F.coalesce("_score", F.lit(0.0))
    zero = F.lit(0)
    return out.select(
        *[F.col("_row")[c].alias(c) for c in own],
        "n_tokens",
        (F.col("_known") + F.coalesce("_more", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_part", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        (-score * math.log2(10) / F.col("_bytes")).alias("bits_per_byte"),
    )
