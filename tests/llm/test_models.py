"""Language identification and context-tree weighting against direct computations."""

import functools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from docs_fixture import make_docs  # noqa: F401
from pyspark.sql import functions as F

from creditpath.llm import ctw, grams, langid


def test_gram_counter_is_exact():
    rng = np.random.default_rng(0)
    counter, seen = grams.Counter(4), Counter()
    for _ in range(20):
        x = rng.integers(0, 500, 300)
        counter.add(x)
        seen.update(x.tolist())
    gram, n = counter.result()
    assert dict(zip(gram.tolist(), n.tolist())) == seen


def test_cache_returns_what_it_evaluates():
    cache = grams.Cache(lambda g: np.stack([g * 2.0, g + 1.0], 1), 2, 4)
    rng = np.random.default_rng(0)
    for _ in range(10):
        x = rng.integers(0, 100, 200)
        assert (cache(x) == np.stack([x * 2.0, x + 1.0], 1)).all()


def test_windows():
    assert grams.windows(np.array([1, 2, 3], np.uint8), 3).tolist() == [1, 0x0102, 0x010203]


def plain_ppm(stats, data, order):
    """Code length of the last byte of each gram, by recursion over sets, all entries kept."""

    def p(context, byte, barred):
        seen = {s: n for s, n in stats[context].items()} if context in stats else {}
        free = {s: n for s, n in seen.items() if s not in barred}
        if free:
            room = sum(free.values()) + len(free)
            if byte in free:
                return free[byte] / room
            escape = len(free) / room
        else:
            escape = 1.0
        barred = barred | set(seen)
        if not context:
            return escape / (256 - len(barred))
        return escape * p(context[1:], byte, barred)

    return [math.log2(p(bytes(data[i - order : i]), data[i], set())) for i in range(order, len(data))]


def test_code_lengths_match_plain_ppm(make_docs):
    random.seed(1)
    texts = ["".join(random.choices("abc d", k=60)) for _ in range(6)]
    model = langid.learn(make_docs([(i, t, "xx") for i, t in enumerate(texts)]))
    stats = defaultdict(Counter)
    pad = b"\0" * langid.ORDER
    for t in texts:
        b = pad + _spaces(t).encode()
        for i in range(langid.ORDER, len(b)):
            for k in range(langid.ORDER + 1):
                stats[b[i - k : i]][b[i]] += 1
    probe = "abd cab zebra  dcc"
    cache = grams.Cache(lambda g: model["xx"].log2(g)[:, None], 1, 8)
    got = next(iter(langid.code_lengths([probe], model, cache)))
    want = -sum(plain_ppm(stats, pad + _spaces(probe).encode(), langid.ORDER))
    assert got[0] == pytest.approx(want, rel=1e-5)


def _spaces(t):
    return " ".join(t.split(" ")) if "  " not in t else _spaces(t.replace("  ", " "))


def test_probabilities_of_a_context_add_up(make_docs):
    model = langid.learn(make_docs([(1, "abra cadabra", "x")]))["x"]
    for context in (b"abr", b"\0\0\0", b"zzz", b"a c"):
        codes = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)])
        assert np.exp2(model.log2(codes)).sum() == pytest.approx(1.0)


def test_identification(make_docs):
    random.seed(2)
    word = {"aa": "abcde", "bb": "vwxyz"}
    rows = [(i, " ".join("".join(random.choices(word[k], k=5)) for _ in range(30)), k) for i, k in enumerate(["aa", "bb"] * 20)]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "12 34 !", "aa"), (103, rows[0][1], None), (0, rows[0][1], "aa"), (None, "VWXYZ wx", "bb")]
    docs = make_docs(rows)
    found = langid.identify(docs, langid.learn(docs)).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id in (100, 101, 102):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == ("bb" if r.text.lower()[0] in "vwxyz" else "aa")
            assert 0.5 < r.score <= 1
    none = langid.identify(docs, langid.learn(make_docs([]))).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in none] == ["und"]


def test_held_out_languages(spark):
    from creditpath.llm.queries import op4_language_id

    got = op4_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()


def test_weights_match_recursion(make_docs, monkeypatch):
    monkeypatch.setattr(ctw, "NODES", 1 << 40)  # all nodes are kept
    texts = ["abab abba", "bab ab", None, ""]
    model = ctw.learn(make_docs(list(enumerate(texts))))
    counts = defaultdict(lambda: [0, 0])
    for t in texts:
        data = bytes([ctw.PAD]) * ctw.DEPTH + ctw.BLANK.join([*ctw.words_of(t), ctw.END])
        for i in range(ctw.DEPTH, len(data)):
            for d in range(ctw.DEPTH + 1):
                for bit in range(8):
                    prefix = 1 << bit | data[i] >> (8 - bit)
                    counts[(data[i - d : i], prefix)][data[i] >> (7 - bit) & 1] += 1

    def kt(a, b):
        p, n = 1.0, 0
        for k in range(a):
            p *= (k + 0.5) / (n + 1)
            n += 1
        for k in range(b):
            p *= (k + 0.5) / (n + 1)
            n += 1
        return p

    def kids(context, prefix):
        return [c for c, q in list(counts) if q == prefix and len(c) == len(context) + 1 and c[1:] == context]

    def weighted(context, prefix):
        own = kt(*counts[(context, prefix)])
        if len(context) == ctw.DEPTH:
            return own
        product = 1.0
        for c in kids(context, prefix):
            product *= weighted(c, prefix)
        return 0.5 * own + 0.5 * product

    def one(path, prefix, d=0):
        context = path[len(path) - d :]
        a, b = counts[(context, prefix)]
        own = (b + 0.5) / (a + b + 1)
        if d == ctw.DEPTH or (path[len(path) - d - 1 :], prefix) not in counts:
            return own
        stop = 0.5 * kt(a, b) / weighted(context, prefix)
        return stop * own + (1 - stop) * one(path, prefix, d + 1)

    for probe in (b"\n\n\nabab", b"abba\n", b"zzab ab"):
        path, byte = probe[-ctw.DEPTH - 1 : -1], probe[-1]
        path = bytes([ctw.PAD]) * (ctw.DEPTH - len(path)) + path
        want = 0.0
        for bit in range(8):
            prefix = 1 << bit | byte >> (8 - bit)
            p = one(path, prefix) if (b"", prefix) in counts else 0.5
            want += math.log10(p if byte >> (7 - bit) & 1 else 1 - p)
        got = model.log10(np.array([int.from_bytes(path + bytes([byte]), "big")]))[0]
        assert got == pytest.approx(want, rel=1e-9)


def test_pruned_trees_still_code_every_context(make_docs, monkeypatch):
    monkeypatch.setattr(ctw, "NODES", 16)
    model = ctw.learn(make_docs([(1, "the cat sat on the mat " * 40)]))
    for context in (b" the ", b"xxxxx", b"\n\n\n\n\n"):
        codes = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)])
        assert (10 ** model.log10(codes)).sum() == pytest.approx(1.0)


def plain_trees(texts):
    """log10 probability of a byte after its context, by counts of every context and recursion over all of them."""
    counts, longer = defaultdict(lambda: [0, 0]), defaultdict(set)
    for t in texts:
        data = bytes([ctw.PAD]) * ctw.DEPTH + ctw.BLANK.join([*ctw.words_of(t), ctw.END])
        for i in range(ctw.DEPTH, len(data)):
            for bit in range(8):
                prefix = 1 << bit | data[i] >> (8 - bit)
                for d in range(ctw.DEPTH + 1):
                    counts[data[i - d : i], prefix][data[i] >> (7 - bit) & 1] += 1
                    if d < ctw.DEPTH:
                        longer[data[i - d : i], prefix].add(data[i - d - 1 : i])

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @functools.cache
    def weighted(context, prefix):
        own = log_kt(*counts[context, prefix])
        if len(context) == ctw.DEPTH:
            return own
        return math.log(0.5) + np.logaddexp(own, sum(weighted(c, prefix) for c in sorted(longer[context, prefix])))

    def one(path, prefix, d):
        context = path[len(path) - d :]
        a, b = counts[context, prefix]
        own = (b + 0.5) / (a + b + 1)
        if d == ctw.DEPTH or (path[len(path) - d - 1 :], prefix) not in counts:
            return own
        stop = math.exp(math.log(0.5) + log_kt(a, b) - weighted(context, prefix))
        return stop * own + (1 - stop) * one(path, prefix, d + 1)

    def log10(path, byte):
        out = 0.0
        for bit in range(8):
            prefix = 1 << bit | byte >> (8 - bit)
            p = one(path, prefix, 0) if (b"", prefix) in counts else 0.5
            out += math.log10(p if byte >> (7 - bit) & 1 else 1 - p)
        return out

    return log10


def rare_texts():
    random.seed(9)
    common = ["the cat sat on the mat " * 60] * 5
    return common + [" ".join("".join(random.choices("abcdeé", k=random.randint(1, 7))) for _ in range(25)) for _ in range(12)] + [None, ""]


@pytest.mark.parametrize("nodes", [16, 200, 1 << 40])
def test_rare_contexts_stay_in_the_tree(make_docs, monkeypatch, nodes):
    """Contexts seen once count like all others, in however many parts the tree is weighed."""
    monkeypatch.setattr(ctw, "NODES", nodes)
    texts = rare_texts()
    model, plain = ctw.learn(make_docs(list(enumerate(texts)))), plain_trees(texts)
    probes = [ctw.BLANK.join([*ctw.words_of(t), ctw.END]) for t in [*texts[4:], "never seen Ünd 123", "eé the"]]
    probes = sorted({(bytes([ctw.PAD]) * ctw.DEPTH + p)[i : i + ctw.DEPTH + 1] for p in probes for i in range(len(p))})
    got = model.log10(np.array([int.from_bytes(p, "big") for p in probes]))
    assert got == pytest.approx([plain(p[:-1], p[-1]) for p in probes], rel=1e-9)
    assert (len(model.bounds) > 10) == (nodes == 16) and (len(model.bounds) == 0) == (nodes == 1 << 40)


@pytest.mark.parametrize("held", [0, 40, 1 << 21])
def test_scores_use_the_whole_tree(make_docs, monkeypatch, held):
    """Whether a gram's probability is at hand or looked up, seen or not: a text's score is the sum over its bytes."""
    monkeypatch.setattr(ctw, "NODES", 64)
    monkeypatch.setattr(ctw, "GRAMS", held)
    texts = rare_texts()
    rows = [*enumerate(texts), (50, "unseen words 99 " * 30), (51, texts[7]), (51, texts[7])]
    docs = make_docs(rows)
    got = ctw.score_documents(docs, docs.where("doc_id < 50")).collect()
    plain = plain_trees(texts)

    def score(text):
        data = bytes([ctw.PAD]) * ctw.DEPTH + ctw.BLANK.join([*ctw.words_of(text), ctw.END])
        return sum(plain(data[i - ctw.DEPTH : i], data[i]) for i in range(ctw.DEPTH, len(data)))

    assert sorted((r.doc_id, round(r.score, 3)) for r in got) == sorted((i, pytest.approx(score(t), abs=2e-3)) for i, t in rows)


def plain_base(rows, learned):
    bag = Counter()
    for t in learned:
        bag.update(ctw.words_of(t))
    n = sum(bag.values()) + len(learned)
    v = len(bag) + (len(learned) > 0)
    cost = n + 0.1 * (v + 1)
    out = []
    for t in rows:
        words = ctw.words_of(t)
        end = len(learned)
        out.append((
            len(words) + 1, sum(w in bag for w in words) + (end > 0), n,
            sum(math.log10((bag[w] + 0.1) / cost) for w in words) + math.log10((end + 0.1) / cost),
        ))
    return out


def test_base_scores(make_docs, monkeypatch):
    monkeypatch.setattr(ctw, "WORDS", 8)  # most words go through the join
    random.seed(4)
    rows = [(i, " ".join(random.choices(["A", "b", "c\td", "É", "ee", "f", "g", "h", "i", "j"], k=random.randint(0, 30)))) for i in range(40)]
    rows += [(90, None), (91, ""), (3, rows[3][1]), (None, "new words here"), (92, "long " * 30_000)]
    docs = make_docs(rows)
    learned = [t for i, t in rows if i is not None and i < 30]
    got = ctw.score_documents(docs, docs.where("doc_id < 30")).collect()
    want = plain_base([t for _, t in rows], learned)
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    assert len(got) == len(rows)
    for g, w in zip(got, sorted(((i, *x) for (i, _), x in zip(rows, want)), key=key)):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9)
        assert g[5] < 0
    none = ctw.score_documents(docs, docs.limit(0)).first()
    assert none.train_tokens == 0 and none.n_known == 0 and none.score == pytest.approx(-8 * math.log10(2) * _bytes(none, rows))
    assert ctw.score_documents(docs.limit(0), docs).count() == 0


def _bytes(row, rows):
    text = next(t for i, t in rows if i == row.doc_id)
    return sum(len(w) + 1 for w in ctw.words_of(text)) + 1


def test_trees_beat_words_on_held_out_texts(spark):
    from creditpath.llm.queries import op2_ctw_score

    held = op2_ctw_score(spark, "/root/testdata/sf0.01").where("held_out").groupBy().sum("score", "base_score").first()
    assert held[0] > held[1]


def test_held_out_flag(spark, make_docs):
    from creditpath.llm.common import id_remainder

    for r in make_docs([(i, "") for i in range(50)]).select("doc_id", id_remainder("doc_id", 10).alias("m")).collect():
        assert r.m == zlib.crc32(str(r.doc_id).encode()) % 10


def test_gibberish_gets_a_low_score(spark, make_docs):
    """Texts of no learned language score low, those of a learned one high, held-out ones too."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = langid.learn(docs.where(~held_out))
    scores = [r.score for r in langid.identify(docs.where(held_out & (F.length("text") >= 200)), model).collect()]
    assert min(scores) > 0.5
    rng = random.Random(3)
    noise = ["".join(rng.choice("qwxzjkvbfgp") for _ in range(300)), " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(60)),
             "Ж" * 30 + " щит и меч, который лежал на столе у окна " * 5]
    found = langid.identify(make_docs(list(enumerate(noise))), model).collect()
    assert all(r.score < 0.5 and r.lang_pred in model for r in found)


def test_thousands_of_language_values(make_docs):
    """A dirty lang column: every value is learned, and nothing is refused."""
    rng = random.Random(4)
    syllables = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(400)]
    rows = [(i, " ".join("".join(rng.choices(syllables[i % 390 : i % 390 + 9], k=2)) for _ in range(12)), f"lang{i:04}") for i in range(2_500)]
    model = langid.learn(make_docs(rows))
    assert set(model) == {r[2] for r in rows}
    some = make_docs(rows[::50])
    found = langid.identify(some.drop("lang"), model).collect()
    assert sum(r.lang_pred == f"lang{r.doc_id:04}" for r in found) >= 0.9 * len(found)
