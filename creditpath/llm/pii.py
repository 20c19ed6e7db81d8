"""Personal data: base patterns, and candidate spans that boosted trees judge.

Base spans come from the fixed patterns and checks and always stay. Around
them, high-recall generators propose overlapping candidates of each kind in
forms that the patterns don't know: other separators, addresses written out or
defanged, phone numbers without a plus. Gradient-boosted trees, one set a kind,
score a candidate by its format and the text around it.

**What they learn from.** Base spans of a bounded sample of documents, and made
ones in the sample's texts, are rewritten into variant forms: right examples.
Wrong ones are the sample's own candidates that fail their kind's check under
any separator, and made dates, amounts, versions, lists and phrases. No feature
tells the base form from a variant. A few hundred made examples in fixed words
are always there, so every kind has a model whatever the table holds. A third
of the examples calibrates the score from which a candidate is added.

All work is done on whole texts, linear in their length; very long ones too.
Of overlapping candidates the one with the higher score stays, of equal scores
the one that starts first, then the longer. Candidates that overlap a base span
give way to it.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpath.llm.common import Shared

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[str, int, int]

#: Documents that the trees learn from: at most this many, the first by a hash of their ids.
SAMPLE_DOCS = 6_000
#: Candidates of these documents that are used at most, by kind.
SAMPLE_CANDIDATES = 20_000
#: A candidate is added from the lowest score on at which this share of the calibration candidates is right.
MIN_PRECISION = 0.995
#: Made examples of each kind in fixed words, beside those of the sample; base spans of a document that are rewritten.
MADE, REWRITTEN = 300, 8
ROUNDS, DEPTH, RATE, BINS = 40, 3, 0.2, 32
#: Characters before a candidate in which cue words count.
CONTEXT = 24
#: A written-out address has at most this many characters before its sign.
LOCAL_CHARS = 64

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

ANY_NUMBER = re.compile(r"\+?\(?[0-9](?:[ ().,/_-]{0,3}[0-9])+")
ANY_QUAD = re.compile(r"(?<![0-9])[0-9]{1,6}(?:(?:[.,:] ?|\[\.\]|\(\.\)| ?\[dot\] ?| ?\(dot\) ?| dot )[0-9]{1,6}){3}", re.I)
WRITTEN_AT = re.compile(r" ?(?:@|＠|\(at\)|\[at\]) ?| at ", re.I)
WRITTEN_DOT = re.compile(r" ?(?:\(dot\)|\[dot\]) ?| dot |\.", re.I)
PLAIN_AT = re.compile(r" at ", re.I)
SEED = 17
#: Signs between the two parts of an address; one space may stand on either side.
AT_SIGNS = ["@", "＠", "(at)", "[at]", "(AT)", "[AT]", " at ", " AT "]
ANY_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?| dot )[A-Za-z0-9-]+)+", re.I)
CUES = {
    "email": re.compile(r"e-?mail|contact|write|@", re.I),
    "ip": re.compile(r"\bip\b|host|server|address", re.I),
    "card": re.compile(r"card|visa|credit|payment|account", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|contact", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost matches of each kind that pass its check, in code points, end exclusive."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = _emails(text)
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out["ip"].append(m.span())
        for m in CARD.finditer(text):
            if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out["card"].append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(_digits(m.group())) <= 15:
                    out["phone"].append(m.span())
    return out


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of high recall."""
    out: list[Span] = []
    if DIGIT.search(text):
        for m in ANY_NUMBER.finditer(text):
            a, b = m.span()
            n = sum("0" <= c <= "9" for c in m.group())
            if 12 <= n <= 19:
                out.append(("card", a + (text[a] in "+(") + (text[a : a + 2] == "+("), b))
            if 7 <= n <= 15:
                out.append(("phone", a, b))
        out += [("ip", *m.span()) for m in ANY_QUAD.finditer(text)]
    for sign in AT_SIGNS:
        at = text.find(sign)
        while at >= 0:
            left = at - (text[at - 1 : at] == " ")
            right = at + len(sign)
            start, least = left, max(0, left - LOCAL_CHARS)
            while start > least and text[start - 1] in LOCAL:
                start -= 1
            domain = ANY_DOMAIN.match(text, right + (text[right : right + 1] == " ")) if start < left else None
            if domain:
                out.append(("email", start, domain.end()))
            at = text.find(sign, right)
    return out


def _char_kind(c: str) -> int:
    return 0 if not c or c.isspace() else 2 if c.isalnum() else 1


def features(text: str, span: Span) -> list[float]:
    """Format of a candidate and the text around it, as numbers."""
    kind, a, b = span
    s = text[a:b]
    groups = re.findall(r"[0-9]+", s)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    local, _, domain = WRITTEN_AT.sub("\0", s, count=1).partition("\0")
    labels = WRITTEN_DOT.split(domain)
    return [
        len(digits), len(s), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        s.count("(") + s.count("["), s.count(" "), s.count("-"), s.count("."), s.count(","), s.count(":"),
        sum(s.count(c) for c in "/_"), bool(digits) and luhn(digits),
        all(len(g) <= 3 and int(g) <= 255 for g in groups), len(WRITTEN_DOT.findall(domain)) - domain.count("."),
        bool(PLAIN_AT.search(s)), len(labels), len(labels[-1]), sum(c.isalpha() for c in labels[-1]),
        sum(c.isalpha() for c in local), sum(c in "._%+-" for c in local), sum(c.isdigit() for c in local),
        _char_kind(text[a - 1 : a]), _char_kind(text[b : b + 1]),
        bool(CUES[kind].search(text, max(0, a - CONTEXT), a)), int(digits[0]) if digits else -1,
    ]


# --------------------------------------------------------------------------
# examples

WORDS = "the report from this week says that one of our readers wrote again about it and we answered on the same day".split()
NAMES = "jane john mary sales info peter anna support maria otto li wei ben office karl lena".split()
HOSTS = "example mail acme north-star river house city web data cloud".split()
ENDS = "com org net de fr io co.uk edu".split()


def luhn_completed(digits: str) -> str:
    return next(digits + str(d) for d in range(10) if luhn(digits + str(d)))


def made_value(kind: str, rng: random.Random) -> str:
    """A value in its base form."""
    some = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == "email":
        local = rng.choice(NAMES) + rng.choice(["", f".{rng.choice(NAMES)}", f"_{rng.choice(NAMES)}", some(2)])
        return f"{local}@{rng.choice(['', 'mail.'])}{rng.choice(HOSTS)}{rng.choice(['', some(1)])}.{rng.choice(ENDS)}"
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == "card":
        head = rng.choice(["4", "51", "37", "6011"])
        return luhn_completed(head + some(15 - len(head)))
    return "+" + rng.choice(["1", "44", "49", "33", "86"]) + some(rng.choice([9, 10]))


def rewritten(kind: str, value: str, rng: random.Random) -> str:
    """A base form's value in a form that the patterns don't match."""
    if kind == "email":
        local, _, host = value.partition("@")
        at = rng.choice([" (at) ", " [at] ", "(at)", "[at]", " at ", " AT ", "＠", " [AT] ", " (AT) "])
        plain = at.strip().lower() == "at"
        dot = rng.choice([" dot ", " DOT "] if plain else [".", ".", " dot ", " (dot) ", " [dot] ", "[dot]", "(dot)"])
        return local + at + host.replace(".", dot)
    if kind == "ip":
        return value.replace(".", rng.choice(["[.]", "(.)", " dot ", " [dot] ", ". ", "[dot]"]))
    digits = _digits(value)
    if kind == "card":
        sep = rng.choice(["/", ".", "_", " / ", " - ", "  ", ", "])
        return sep.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    head, mid, tail = digits[:-7], digits[-7:-4], digits[-4:]
    if len(head) > 3:
        area = head[-3:]
        head = rng.choice(["", head[:-3] + rng.choice([" ", "-", "."]), "00" + head[:-3] + " "])
    else:
        area, head = head, ""
    sep = rng.choice(["-", ".", " ", "/"])
    return head + rng.choice([f"({area}) {mid}{sep}{tail}", f"({area}){mid}{sep}{tail}", f"{area}{sep}{mid}{sep}{tail}", f"{area}{sep}{mid}{sep}{tail}"])


def made_other(rng: random.Random) -> str:
    """Numbers and phrases that look alike but are no personal data."""
    n = rng.randrange
    return rng.choice(
        [
            lambda: f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02} {n(24):02}:{n(60):02}:{n(60):02}",
            lambda: f"{n(1, 29):02}.{n(1, 13):02}.{n(1900, 2100)}, {n(24):02}.{n(60):02}",
            lambda: f"{n(1, 29)}/{n(1, 13)}/{n(1900, 2100)} - {n(1, 29)}/{n(1, 13)}/{n(1900, 2100)}",
            lambda: f"{n(1, 999)},{n(1000):03},{n(1000):03}" + rng.choice(["", f",{n(1000):03}", f".{n(100):02}"]),
            lambda: f"{n(10)}.{n(10**6, 10**12)}",
            lambda: str(n(10**6, 10 ** rng.choice([8, 10, 12, 14, 16, 18]))),
            lambda: ", ".join(str(n(1, 10 ** rng.choice([2, 3, 4]))) for _ in range(n(4, 8))),
            lambda: f"{n(1900, 2000)}-{n(2000, 2030)}, {n(1, 300)}-{n(300, 900)}",
            lambda: ".".join(str(n(256, 9999) if i == 2 else n(20)) for i in range(4)),
            lambda: f"{n(24):02}:{n(60):02}:{n(60):02}:{n(25):02}",
            lambda: ".".join(str(n(1, 30)) for _ in range(3)) + f". {n(300, 2030)}",
            lambda: f"978-{n(10)}-{n(10, 99)}-{n(10**5, 10**6)}-{n(10)}",
            lambda: f"{n(-90, 90)}.{n(10**4, 10**6)}, {n(180)}.{n(10**4, 10**6)}",
            lambda: f"({n(100)}) {n(100)} ({n(100)}) {n(1000, 9999)}",
            lambda: f"{rng.choice(WORDS)} at {rng.choice(HOSTS)}.{rng.choice(ENDS)}",
            lambda: f"{n(1, 20)} @ {n(1, 99)}.{n(100):02}",
            lambda: f"{rng.choice(WORDS)} at {rng.choice(WORDS)}.{rng.choice(['', ' '])}{rng.choice(WORDS).title()}",
            lambda: f"{n(10**15, 10**16 - 1)}/{n(10)}",
            lambda: " ".join(str(n(1000, 9999)) for _ in range(4)),
        ]
    )()


Example = tuple[str, bool, list[float]]


def judged(kind: str, before: str, value: str, after: str, right: bool) -> list[Example]:
    """Candidates of a value between two texts: the whole of it is right or not, other stretches of it are wrong.

    Other stretches count for the same kind only: a card's digits may well be a phone number's.
    """
    text, a, b = before + value + after, len(before), len(before) + len(value)
    out = []
    for c in candidates(text):
        if c[1] < b and c[2] > a and (c[0] == kind or not right):
            whole = right and c[1:] == (a, b)
            if right and not whole and c[1] <= a and c[2] >= b:
                continue  # the text around goes on with digits; no one can tell
            out.append((c[0], whole, features(text, c)))
    return out


def plainly_wrong(text: str, span: Span) -> bool:
    """Fails its kind's check, whatever the separators."""
    kind, a, b = span
    s = text[a:b]
    digits = _digits(s)
    if kind == "card":
        return not (13 <= len(digits) <= 19 and luhn(digits))
    if kind == "phone":
        return not 9 <= len(digits) <= 15 or s == digits
    if kind == "ip":
        return any(len(g) > 3 or int(g) > 255 for g in re.findall(r"[0-9]+", s))
    return bool(PLAIN_AT.search(s)) and "." in s


def examples(text: str, rng: random.Random) -> list[Example]:
    """What a document teaches: its base spans rewritten, made values and other numbers in it, its own wrong candidates."""
    base = base_spans(text)
    taken = sorted(s for spans in base.values() for s in spans)
    out = []
    for kind in KINDS:
        for a, b in base[kind][:REWRITTEN]:
            value = rewritten(kind, text[a:b], rng)
            out += judged(kind, text[max(0, a - 2 * CONTEXT) : a], value, text[b : b + CONTEXT], True)
    blanks = [m.start() for m in re.finditer(" ", text[: 1 << 16])]
    for kind in KINDS if blanks else []:
        for right in (True, False):
            at = rng.choice(blanks) + 1
            value = rewritten(kind, made_value(kind, rng), rng) if right else made_other(rng)
            out += judged(kind, text[max(0, at - 2 * CONTEXT) : at], value, " " + text[at : at + CONTEXT], right)
    for c in candidates(text):
        k = bisect_left(taken, (c[2],))
        if plainly_wrong(text, c) and not any(b > c[1] for _, b in taken[max(0, k - 8) : k]):
            out.append((c[0], False, features(text, c)))
    return out


def made_examples() -> list[Example]:
    rng = random.Random(SEED)
    out = []
    for i in range(MADE * len(KINDS)):
        kind = KINDS[i % len(KINDS)]
        for value, right in ((rewritten(kind, made_value(kind, rng), rng), True), (made_other(rng), False), (made_other(rng), False)):
            before, after = (" ".join(rng.choices(WORDS, k=4)) for _ in range(2))
            out += judged(kind, before + " ", value, rng.choice([" ", ", ", ". "]) + after, right)
    return out


@dataclass(frozen=True)
class Trees:
    """Boosted trees of equal depth: at each inner node a feature and a threshold, at each leaf a step."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Logistic gradient boosting with Newton steps, over quantile bins of each feature."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    edges = [np.unique(np.concatenate([e, [(c.min() + c.max()) / 2]])) for e, c in zip(edges, x.T)]
    bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)
    n_inner = 2**DEPTH - 1
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    total = np.full(len(y), start)
    features_, thresholds, leaves = [], [], []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        f, t = np.zeros(n_inner, np.int64), np.full(n_inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for inner in range(n_inner):
            rows = np.flatnonzero(node == inner)
            best = 1e-6
            if len(rows) > 1:
                base = g[rows].sum() ** 2 / (h[rows].sum() + 1)
                for k, e in enumerate(edges):
                    gs = np.cumsum(np.bincount(bins[rows, k], g[rows], len(e) + 1))
                    hs = np.cumsum(np.bincount(bins[rows, k], h[rows], len(e) + 1))
                    gain = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1) - base
                    if len(gain) and gain.max() > best:
                        best = gain.max()
                        f[inner], t[inner] = k, e[int(gain.argmax())]
            node[rows] = 2 * inner + 1 + (x[rows, f[inner]] > t[inner])
        leaf = node - n_inner
        steps = RATE * np.bincount(leaf, g, n_inner + 1) / (np.bincount(leaf, h, n_inner + 1) + 1)
        total += steps[leaf]
        features_.append(f)
        thresholds.append(t)
        leaves.append(steps)
    return Trees(start, np.array(features_), np.array(thresholds), np.array(leaves))


def calibrate(score: np.ndarray, y: np.ndarray) -> float:
    """Lowest score, one half at least, from which on enough of the candidates are right; infinite if there is none."""
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(score[order][1:] != score[order][:-1], True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero((right >= MIN_PRECISION) & last)
    return max(0.5, float(score[order][good[-1]])) if len(good) else float("inf")


Model = dict[str, tuple[Trees, float]]


def learn(docs: DataFrame) -> Model:
    """Trees and thresholds of every kind, from the first SAMPLE_DOCS documents by a hash of their ids."""
    chosen = (
        docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_DOCS)
        .distinct()
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # SAMPLE_DOCS rows at most

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = examples(text or "", random.Random(zlib.crc32(str(doc).encode())))
                rows += [(doc, i, *e) for i, e in enumerate(found)]
            c = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()), pa.array(c[3], pa.bool_()),
                    pa.array([list(map(float, f)) for f in c[4]], pa.list_(pa.float64())),
                ],
                names=["doc_id", "n", "kind", "right", "features"],
            )

    found = sample.mapInArrow(run, "doc_id long, n long, kind string, right boolean, features array<double>")
    got = (
        found.orderBy(F.xxhash64("doc_id", "n"), "doc_id", "n", "kind", "right", "features").limit(SAMPLE_CANDIDATES * len(KINDS)).collect()
    )
    fixed = made_examples()
    model: Model = {}
    for kind in KINDS:
        rows = [(r, f) for k, r, f in fixed if k == kind] + [(r["right"], r["features"]) for r in got if r["kind"] == kind][:SAMPLE_CANDIDATES]
        y, x = np.array([r for r, _ in rows], float), np.array([f for _, f in rows], float)
        held = np.arange(len(y)) % 3 == 2
        trees = boost(x[~held], y[~held])
        model[kind] = (trees, calibrate(trees.score(x[held]), y[held]))
    return model


def all_spans(text: str, base: dict[str, list[tuple[int, int]]], model: Model) -> list[Span]:
    """Base spans, and the best-scoring candidates over their kind's threshold that overlap nothing taken."""
    taken = [(k, a, b) for k in KINDS for a, b in base[k]]
    scored = []
    edges = sorted((a, b) for _, a, b in taken)
    starts, reach = [a for a, _ in edges], list(accumulate((b for _, b in edges), max))

    def overlaps(c: Span) -> bool:
        before = bisect_left(starts, c[2])  # base spans that start before its end
        return before > 0 and reach[before - 1] > c[1]

    proposed = [c for c in candidates(text) if c[0] in model and not overlaps(c)] if model else []
    for kind in KINDS:
        own = [c for c in proposed if c[0] == kind]
        if own:
            trees, least = model[kind]
            score = trees.score(np.array([features(text, c) for c in own], float))
            scored += [(-s, c[1], -c[2], c) for s, c in zip(score.tolist(), own) if s >= least]
    added: list[tuple[int, int, str]] = []  # by start, without overlaps
    for *_, (kind, a, b) in sorted(scored):
        k = bisect_left(added, (b,))
        if not k or added[k - 1][1] <= a:
            insort(added, (a, b, kind))
    return sorted(taken + [(k, a, b) for a, b, k in added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every stretch that spans cover replaced by its first kind, like ``[EMAIL]``."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: counts and digest of base spans, all spans, and the number that the trees added.

    A null text counts as empty; repeated rows stay; an empty table gives none.
    Columns other than doc_id and text are not read.
    """
    shared = Shared(docs.sparkSession, learn(docs) if model is None else model)

    def run(batches):
        trees = shared.value
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                spans = all_spans(text or "", base, trees)
                plain = _joined([(k, a, b) for k in KINDS for a, b in base[k]])
                counts = [len(base[k]) for k in KINDS]
                digest = hashlib.sha256(plain.encode()).hexdigest()
                rows.append((*counts, digest, _joined(spans), len(spans) - sum(counts)))
            c = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in c[:4]),
                    pa.array(c[4], pa.string()), pa.array(c[5], pa.string()), pa.array(c[6], pa.int64()),
                ],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")


def redact_documents(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Every row with all its columns, the text redacted; a null text stays null."""
    shared = Shared(docs.sparkSession, learn(docs) if model is None else model)

    def run(batches):
        trees = shared.value
        for batch in batches:
            texts = [
                t and redact(t, all_spans(t, base_spans(t), trees)) for t in batch.column("text").to_pylist()
            ]
            at = batch.schema.names.index("text")
            yield batch.set_column(at, "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
