"""Quality rules learned as a decision list over text statistics.

The statistics are DataFrame expressions over each whole text. Sequential
covering learns the list from labelled statistics: a rule is grown, one
threshold condition at a time, on two thirds of the labelled rows, pruned from
its end on the remaining third and kept while it is precise there; the rows it
covers leave the set and the next rule is grown. The list becomes one ordered
conditional expression: the first rule that holds rejects the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditpath.llm.common import set_aside

SPACES = " \t\n\x0b\f\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Labelled rows to learn from: at most this many, the first by a hash of their ids.
SAMPLE_ROWS = 8_000
#: Rules are refused below this precision on the pruning rows.
MIN_PRECISION = 0.95
#: Labelled rows that a rule must cover at least.
MIN_COVER = 8
MAX_CONDITIONS = 4
MAX_RULES = 16
#: Candidate thresholds per statistic.
QUANTILES = 64

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


#: Columns that are made on the way.
MADE = {"__words", "__n_words", "__hashes", "__repeats", "__placed", "__lines"}


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the five counts of COUNTS to every row; a null or empty text has zeros.

    Repeated words are found per row: three-word windows are hashed, and only
    where two hashes are equal are they sorted to mark the words they cover.
    No row is exploded or shuffled, however long its text. Columns named like
    a count are replaced; all others stay, whatever their names.
    """
    return set_aside(docs, MADE, lambda own: _text_counts(own, text_col))


def _text_counts(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("__words", F.array_remove(F.split(text, SPACE_PATTERN), ""))
    out = out.withColumn("__n_words", F.size("__words").cast("long"))
    window = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("__words") - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)),
    )
    none = F.array().cast("array<bigint>")
    out = out.withColumn("__hashes", F.when(F.size("__words") >= 3, window).otherwise(none))
    out = out.withColumn("__repeats", F.size(F.array_distinct("__hashes")) < F.size("__hashes"))
    placed = F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__placed", F.when(F.col("__repeats"), placed))
    twice = F.filter(
        "__placed",
        lambda p, k: F.get("__placed", k - 1)["h"].eqNullSafe(p["h"]) | F.get("__placed", k + 1)["h"].eqNullSafe(p["h"]),
    )
    covered = F.flatten(F.transform(twice, lambda p: F.array(p["i"], p["i"] + 1, p["i"] + 2)))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = F.struct(
        F.col("__n_words").alias("n_words"),
        F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("__repeats"), F.size(F.array_distinct(covered))), F.lit(0))
        .cast("long")
        .alias("n_repeat_words"),
    )
    # made by a generator, below which no later filter on the counts is moved:
    # there it would compute them a second time, word by word
    kept = [F.col(c) for c in docs.columns if c not in COUNTS]
    return out.withColumn("__lines", lines).select(*kept, F.inline_outer(F.array(counts)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")
    )


def statistics() -> dict[str, Column]:
    """What conditions may test, by name: the counts and their shares of the words."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"),
        "symbols_per_word": F.col("n_symbols") / words,
        "chars_per_word": F.col("word_chars") / words,
        "dup_lines_per_word": F.col("n_dup_lines") / words,
        "repeat_share": F.col("n_repeat_words") / words,
    }


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        v = x[:, names.index(self.statistic)]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        v = statistics()[self.statistic]
        return v > self.threshold if self.above else v <= self.threshold


Rule = tuple[Condition, ...]


def _thresholds(v: np.ndarray) -> np.ndarray:
    """Midway between a quantile and the next larger value seen."""
    seen = np.unique(v)
    at = np.unique(np.searchsorted(seen, np.quantile(v, np.linspace(0, 1, QUANTILES + 1), method="lower")))
    at = at[at + 1 < len(seen)]
    return (seen[at] + seen[at + 1]) / 2


def _grow(x: np.ndarray, y: np.ndarray, names: list[str]) -> list[Condition]:
    """Adds the condition with the largest information gain until no good row is covered."""
    rule, inside = [], np.ones(len(y), bool)
    while len(rule) < MAX_CONDITIONS and (~y[inside]).any() and y[inside].any():
        before = np.log2(y[inside].mean())
        best, gain = None, 1e-9
        for f, name in enumerate(names):
            v = x[inside, f]
            for t in _thresholds(v):
                for above in (True, False):
                    hit = v > t if above else v <= t
                    p, n = (hit & y[inside]).sum(), hit.sum()
                    if p >= MIN_COVER and p * (np.log2(p / n) - before) > gain:
                        gain, best = p * (np.log2(p / n) - before), Condition(name, above, float(t))
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x, names)
    return rule


def _covers(rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def _prune(rule: list[Condition], x: np.ndarray, y: np.ndarray, names: list[str]) -> tuple[list[Condition], float]:
    """Drops final conditions while that doesn't lower (bad - good) / covered on the pruning rows."""
    best, worth, precision = rule, -2.0, 0.0
    for k in range(len(rule), 0, -1):
        hit = _covers(rule[:k], x, names)
        if hit.any():
            p = y[hit].mean()
            if 2 * p - 1 >= worth:
                best, worth, precision = rule[:k], 2 * p - 1, p
    return best, precision


def learn_rules(x: np.ndarray, reject: np.ndarray, names: list[str]) -> list[Rule]:
    """Sequential covering over labelled statistics; rows must come in an order free of meaning."""
    rules: list[Rule] = []
    third = np.arange(len(x)) % 3 == 2
    while len(rules) < MAX_RULES:
        grow, prune = ~third, third
        if reject[grow].sum() < MIN_COVER or not prune.any():
            break
        rule = _grow(x[grow], reject[grow], names)
        if not rule:
            break
        rule, precision = _prune(rule, x[prune], reject[prune], names)
        hit = _covers(rule, x, names)
        if precision < MIN_PRECISION or hit.sum() < MIN_COVER:
            break
        rules.append(tuple(rule))
        x, reject, third = x[~hit], reject[~hit], third[~hit]
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and rejection labels of a bounded sample: the first rows by a hash of the id.

    A document labelled more than once counts with its lowest quality; null
    labels and ids and base failures teach nothing.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("__quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `rows` rows
    got = (
        text_counts(found)
        .where(~base_failed())
        .select(F.xxhash64("doc_id").alias("_at"), (F.col("__quality") == 0).alias("_reject"), *[c.alias(n) for n, c in statistics().items()])
        .orderBy("_at", *statistics())
        .limit(rows)
        .collect()
    )
    names = list(statistics())
    x = np.array([[r[n] for n in names] for r in got], float).reshape(-1, len(names))
    return x, np.array([r["_reject"] for r in got], bool)


def rejected_by(rules: list[Rule]) -> Column:
    """The list as one conditional: the first rule that holds rejects; otherwise the text stays."""
    out = F.lit(False)
    for rule in reversed(rules):
        test = F.lit(True)
        for c in rule:
            test = test & c.column()
        out = F.when(test, F.lit(True)).otherwise(out)
    return out


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds the counts, base_failed and kept to every row; columns of these names are replaced.

    Without labels the list is empty and only the base rules reject. A null or
    empty text fails the base rules; repeated rows stay, each judged alike, and
    so do rows with null ids; an empty table stays empty. Between conditions
    that gain the same the first one tried is learned.
    """
    x, reject = labelled_statistics(docs, labels)
    rules = learn_rules(x, reject, list(statistics()))
    out = text_counts(docs).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & ~rejected_by(rules))
