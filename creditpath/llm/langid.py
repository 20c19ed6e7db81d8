"""Language identification by prediction by partial matching.

Each language has context trees of orders 3 to 0 over the bytes of lower-case
letters, other ASCII characters being one space. A byte that a context has
seen often enough is coded there; else an escape is coded and the next shorter
context tried, without the bytes that the longer one would have coded, down to
all 256 bytes. With the counts frozen, a text's code length is the sum over its
bytes; the language with the shortest code is predicted.

Counts cover the whole corpus. A model keeps the entries with at least
1/ENTRIES of a language's bytes, hence ENTRIES of them an order at most (fewer
where languages are many, ALL_ENTRIES in all); what the rest has counted is
part of its context's escape. Any number of languages is taken: what a task
holds besides the model doesn't grow with it.

The score tells two things: how much likelier the language is than the others,
and whether the text is as cheap to code as texts of that language are. The
latter is judged by the mean and spread of bits a byte over all that was
learned of the language, with room for short texts, so that gibberish and
languages never seen get a low score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from creditpath.llm.common import Shared, batch_slices, cut, text_slices
from creditpath.llm.grams import Cache, Counter, windows

ORDER = 3
#: Entries of one order and language are at most this many.
ENTRIES = 1 << 15
ALL_ENTRIES = 1 << 20
#: Numbers that are held at once for the languages of some grams.
HELD = 1 << 22
#: A text is as good as rejected from so many spreads of one byte's bits over the mean on, plus so many spreads of a text's mean.
OVER_MEAN, OVER_TEXT = 1.2, 4.0
STEEPNESS = 10.0
UNKNOWN = "und"

PAD = 0
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def letter_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of ORDER + 1 bytes at every byte of the texts, and how many each text has.

    White space, digits and signs become one space; every text starts from a
    context of padding.
    """
    coded = [t.lower().encode() for t in texts]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    data = _LETTERS[np.frombuffer(b"".join(coded), np.uint8)]
    of = np.repeat(np.arange(len(coded)), sizes)
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20) | (of[1:] != of[:-1])
    data, of = data[keep], of[keep]
    count = np.bincount(of, minlength=len(coded))
    padded = np.full(len(data) + ORDER * len(coded), PAD, np.uint8)
    place = np.arange(len(data)) + ORDER * (of + 1)
    padded[place] = data
    return windows(padded, ORDER + 1)[place], count


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, gram and count over all texts with a language and a letter; counted in the tasks first."""

    def run(batches):
        names: dict[str, int] = {}  # a language's number stands above the gram's bytes
        counter = Counter(20)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for a, b, texts in batch_slices(batch):
                use = [i for i, t in enumerate(texts) if has_letter(t)]
                if use:
                    gram, count = letter_grams([texts[i] for i in use])
                    of = np.array([names.setdefault(langs[a + i], len(names)) for i in use], np.int64)
                    counter.add(gram | np.repeat(of, count) << 8 * (ORDER + 1))
        key, n = counter.result()
        lang = pa.DictionaryArray.from_arrays(pa.array(key >> 8 * (ORDER + 1), pa.int32()), pa.array(list(names), pa.string()))
        yield pa.RecordBatch.from_arrays(
            [lang.cast(pa.string()), pa.array(key & _mask(ORDER + 1)), pa.array(n)], names=["lang", "gram", "n"]
        )

    learned = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    partial = learned.mapInArrow(run, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """Frozen statistics of one language: sorted entries and contexts of each order; mean and spread of a byte's bits."""

    mean, spread = 0.0, 1.0

    def __init__(self, entries: dict[int, tuple[np.ndarray, np.ndarray]], contexts: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.entries, self.contexts = entries, {}
        for order in range(ORDER + 1):
            gram, n = entries[order]
            context, total = contexts[order]
            at = np.searchsorted(context, gram >> 8)
            kept = np.bincount(at, n, len(context))
            distinct = np.bincount(at, minlength=len(context)).astype(float)
            # what the next shorter context has counted of the bytes that this one codes
            shorter = np.zeros(len(context))
            if order:
                low, low_n = entries[order - 1]
                found = np.searchsorted(low, gram & _mask(order))
                shorter = np.bincount(at, low_n[found], len(context))
            self.contexts[order] = (context, total.astype(float), kept, distinct, shorter)

    def log2(self, grams: np.ndarray) -> np.ndarray:
        """log2 probability of each gram's last byte after the others."""
        out = np.zeros(len(grams))
        active = np.ones(len(grams), bool)
        barred, n_barred = np.zeros(len(grams)), np.zeros(len(grams))
        for order in range(ORDER, -1, -1):
            key = grams & _mask(order + 1)
            context, total, kept, distinct, shorter = self.contexts[order]
            if not len(context):
                continue
            at = np.minimum(np.searchsorted(context, key >> 8), len(context) - 1)
            present = active & (context[at] == key >> 8)
            room = total[at] - barred + distinct[at] - n_barred
            here = present & (room > 0)
            entry, count = self.entries[order]
            e = np.minimum(np.searchsorted(entry, key), len(entry) - 1)
            coded = here & (entry[e] == key)
            out[coded] += np.log2(count[e[coded]] / room[coded])
            escaped = here & ~coded
            free = (total[at] - kept[at] + distinct[at] - n_barred)[escaped]
            out[escaped] += np.log2(free / room[escaped])
            active &= ~coded
            # entries nest, so what a context codes holds all that longer ones do
            barred = np.where(present, shorter[at], 0.0)
            n_barred = np.where(present, distinct[at], 0.0)
        return np.where(active, out - np.log2(np.maximum(256 - n_barred, 1)), out)


def _mask(size: int) -> int:
    return (1 << 8 * size) - 1


def learn(docs: DataFrame) -> dict[str, Trees]:
    """Trees by language from all rows of ``docs``; null texts and languages teach nothing."""
    grams = cut(count_grams(docs))
    n_langs = grams.select("lang").distinct().count()
    entries_each = max(1, min(ENTRIES, ALL_ENTRIES // max(1, n_langs)))
    least = grams.groupBy("lang").agg((F.sum("n") / entries_each).alias("least"))
    orders = F.explode(F.array(*[F.struct(F.lit(k).alias("order"), F.lit(_mask(k + 1)).alias("mask")) for k in range(ORDER + 1)]))
    entries = (
        grams.select("lang", "gram", "n", orders.alias("o"))
        .groupBy("lang", F.col("o.order").alias("order"), F.col("gram").bitwiseAND(F.col("o.mask")).alias("gram"))
        .agg(F.sum("n").alias("n"))
    )
    contexts = entries.groupBy("lang", "order", F.shiftright("gram", 8).alias("gram")).agg(F.sum("n").alias("n"))
    kept = (
        entries.withColumn("what", F.lit(0))
        .unionByName(contexts.withColumn("what", F.lit(1)))
        .join(least, "lang")
        .where(F.col("n") >= F.col("least"))
        .select("lang", "order", "what", "gram", "n")
    )
    got = kept.toArrow()  # at most 2 * (ORDER + 1) * ALL_ENTRIES rows
    names, lang = np.unique(got.column("lang").to_numpy().astype(str), return_inverse=True)
    what, order, gram, n = (got.column(c).to_numpy().astype(np.int64) for c in ("what", "order", "gram", "n"))
    part = (lang * 2 + what) * (ORDER + 1) + order
    by = np.lexsort((gram, part))
    gram, n, edges = gram[by], n[by], np.searchsorted(part[by], np.arange(len(names) * 2 * (ORDER + 1) + 1))
    model = {}
    for k, name in enumerate(names.tolist()):
        at = [slice(*edges[(2 * k) * (ORDER + 1) + i : (2 * k) * (ORDER + 1) + i + 2]) for i in range(2 * (ORDER + 1))]
        parts = [{i: (gram[at[w * (ORDER + 1) + i]], n[at[w * (ORDER + 1) + i]]) for i in range(ORDER + 1)} for w in (0, 1)]
        # contexts without an entry of their own code nothing
        for i in range(ORDER + 1):
            context, total = parts[1][i]
            own = np.isin(context, parts[0][i][0] >> 8)
            parts[1][i] = (context[own], total[own])
        model[name] = Trees(*parts)
    _measure(grams, model)
    return model


def _measure(grams: DataFrame, model: dict[str, Trees]) -> None:
    """Mean and spread of the bits of a byte, over all grams of each language."""
    if not model:
        return
    shared = Shared(grams.sparkSession, model)

    def run(batches):
        trees = shared.value
        for batch in batches:
            names, lang = np.unique(batch.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            gram, n = batch.column("gram").to_numpy(), batch.column("n").to_numpy()
            sums = np.zeros((3, len(names)))
            for k, name in enumerate(names.tolist()):
                own = lang == k
                bits = -trees[name].log2(gram[own])
                sums[:, k] = n[own].sum(), (n[own] * bits).sum(), (n[own] * bits * bits).sum()
            yield pa.RecordBatch.from_arrays([pa.array(names.tolist()), *map(pa.array, sums)], names=["lang", "n", "bits", "squares"])

    sums = grams.sortWithinPartitions("lang").mapInArrow(run, "lang string, n double, bits double, squares double")
    for r in sums.groupBy("lang").agg(F.sum("n").alias("n"), F.sum("bits").alias("bits"), F.sum("squares").alias("squares")).collect():
        trees = model[r.lang]
        trees.mean = r.bits / r.n
        trees.spread = max(0.5, float(np.sqrt(max(0.0, r.squares / r.n - trees.mean**2))))


def code_lengths(texts: list[str], model: dict[str, Trees], cache: Cache) -> Iterator[np.ndarray]:
    """Bits of each text in each language, in the model's order."""
    for bits, _ in sized_code_lengths(texts, model, cache):
        yield bits


def sized_code_lengths(texts: list[str], model: dict[str, Trees], cache: Cache) -> Iterator[tuple[np.ndarray, int]]:
    """Those bits, and the bytes that were coded."""
    step = max(1, HELD // max(1, len(model)))
    for a, b in text_slices(texts):
        gram, count = letter_grams(texts[a:b])
        bits = np.zeros((b - a, len(model)))
        of = np.repeat(np.arange(b - a), count)
        for low in range(0, len(gram), step):
            rows = of[low : low + step]
            first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            bits[rows[first]] -= np.add.reduceat(cache(gram[low : low + step]), first, axis=0, dtype=np.float64)
        yield from zip(bits, count.tolist())


def gram_cache(trees: dict[str, Trees]) -> Cache:
    """Cache of all languages' values, with fewer slots the more languages there are."""
    languages = list(trees.values())

    def evaluate(grams: np.ndarray) -> np.ndarray:
        return np.stack([t.log2(grams) for t in languages], 1)

    return Cache(evaluate, len(languages), max(8, min(20, (2 * HELD // len(languages)).bit_length() - 1)))


def fit(trees: Trees, bits: float, n: int) -> float:
    """Near 1 for texts that cost what the language's own do, 0.5 at the limit, near 0 beyond."""
    limit = trees.mean + trees.spread * (OVER_MEAN + OVER_TEXT / np.sqrt(n))
    return float(1 / (1 + np.exp2(np.clip(STEEPNESS * (bits / n - limit) / trees.spread, -1000, 1000))))


def identify(docs: DataFrame, model: dict[str, Trees], text_col: str = "text") -> DataFrame:
    """Adds lang_pred and score, replacing columns of these names; all other columns and rows stay.

    The score is the language's probability given the text, all languages
    being equally likely before, times how well the text fits it. A text that is null or has no letter, or any
    text if nothing was learned, is ``und`` with score 0. Equal code lengths go
    to the first language by name.
    """
    docs = docs.drop("lang_pred", "score")
    shared = Shared(docs.sparkSession, dict(sorted(model.items())))

    def run(batches):
        trees = shared.value
        names = list(trees)
        cache = gram_cache(trees) if names else None
        for batch in batches:
            best, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            for a, _, texts in batch_slices(batch, text_col):
                known = [i for i, t in enumerate(texts) if names and has_letter(t)]
                lengths = sized_code_lengths([texts[i] for i in known], trees, cache) if known else ()
                for i, (bits, n) in zip(known, lengths):
                    k = int(bits.argmin())
                    best[a + i] = names[k]
                    score[a + i] = fit(trees[names[k]], bits[k], n) / np.exp2(np.maximum(bits[k] - bits, -1000.0)).sum()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"]
            )

    schema = StructType([*docs.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    return docs.mapInArrow(run, schema)
