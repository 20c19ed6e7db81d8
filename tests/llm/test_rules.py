"""Quality rules, URL filters and personal data against plain Python."""

import random
import re

import numpy as np
import pytest
from docs_fixture import make_docs  # noqa: F401
from pyspark.sql import functions as F

from creditpath.llm import pii, quality, url_filters

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [None, "", " \n\t", "a b c", "a b c a b c", "a b c\n\na b c\n\x0b", "x\x85y z\xa0w", "é" * 5, "# $ <a>|&*%", "a a a a a a", "\n a\na \na\na", ("one two three four " * 3000)]


def test_counts(make_docs):
    random.seed(1)
    texts = TEXTS + ["".join(random.choices(["a ", "b ", "c ", "\n", "#", "\t"], k=40)) for _ in range(60)]
    got = quality.text_counts(make_docs([(i, t) for i, t in enumerate(texts)])).collect()
    assert len(got) == len(texts)
    for r in got:
        if r.doc_id != 11:
            assert tuple(r[c] for c in quality.COUNTS) == plain_counts(texts[r.doc_id]), texts[r.doc_id]
        assert r.root == "r"
    assert {r.doc_id: r for r in got}[11].n_repeat_words == 12_000


def test_rules_cover_what_is_planted():
    rng = np.random.default_rng(0)
    x = rng.random((3_000, 2))
    bad = (x[:, 0] > 0.7) & (x[:, 1] <= 0.4)
    rules = quality.learn_rules(x, bad, ["a", "b"])
    hit = np.zeros(len(x), bool)
    for r in rules:
        hit |= quality._covers(r, x, ["a", "b"])
    assert (hit == bad).mean() > 0.98
    assert quality.learn_rules(x, np.zeros(len(x), bool), ["a", "b"]) == []
    assert quality.learn_rules(x[:0], bad[:0], ["a", "b"]) == []


def test_judged_documents(spark, make_docs):
    random.seed(3)
    word = lambda: "".join(random.choices("abcdefgh", k=6))
    rows = []
    for i in range(240):
        n = random.randint(60, 90)
        rows.append((i, " ".join(word() + ("***" if i % 4 == 0 else "") for _ in range(n))))
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 0), 0) for i in range(240)] + [(None, 0, 0), (5, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int"
    )
    rows += [(900, "too short"), (901, None), (None, rows[1][1]), (1, rows[1][1])]
    got = quality.judge_documents(make_docs(rows), labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50)
        assert r.kept == (not r.base_failed and "*" not in r.text)
    no_labels = quality.judge_documents(make_docs(rows), labels.limit(0)).where("kept = base_failed")
    assert no_labels.count() == 0
    assert quality.judge_documents(make_docs([]), labels).count() == 0


RULES = url_filters.RULES


def plain_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), a, h + p) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_urls(spark):
    random.seed(2)
    parts = ["www.example.com", "example.com", "a.example.com", "EXAMPLE.com", "example.net", "net", "com", "notexample.com", "x.org", "", "É.com"]
    tails = ["", "/", "/en/", "/en", "/es/1", "/fr/a?x=/en/", "#/en/", "/en/1#top", "?q", "//"]
    urls = [None, "", "no scheme", "://", "http://", "a://b://c/d", "http://com\n/x"] + [
        f"http://{random.choice(parts)}{random.choice(tails)}" for _ in range(200)
    ]
    pages = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate([*urls, urls[-1]])], "page_id long, url string, rule string, verdict string")
    for r in url_filters.judge_urls(pages).collect():
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(r.url), r.url
    assert url_filters.judge_urls(pages.limit(0)).count() == 0
    assert {r.verdict for r in url_filters.judge_urls(pages, rules=[]).collect()} == {"allow"}
    with pytest.raises(ValueError):
        url_filters.judge_urls(pages, rules=[("allow", "com", "/"), ("block", "com", "/")])


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(4_000).select(F.concat(F.lit("host"), F.col("id")).alias("key"), (F.col("id") % 9 == 0).alias("listed"))
    levels = url_filters.build_cascade(keys)
    assert len(levels) > 1
    assert keys.where(url_filters.is_listed(F.col("key"), levels) != F.col("listed")).count() == 0
    bits = sum(x.n_bits for x in levels)
    assert bits < 4_000 * 3
    assert url_filters.build_cascade(keys.where("not listed")) == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = {k: [] for k in pii.KINDS}
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and not all(int(p) <= 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out[kind].append(m.span())
    return out


def test_base_spans_match_the_patterns():
    random.seed(3)
    parts = [*"0123456789", ".", "@", "+", "-", " ", "(", ")", "a", "B", "_", "1.2.3.4", "4111111111111111", "a@b.c", "+1 (988) 555-2485", "é"]
    for _ in range(8_000):
        text = "".join(random.choices(parts, k=random.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_very_long_texts_are_linear():
    text = "a" * 100_000 + "1" * 100_000 + "." * 50_000 + "+" * 50_000 + "@" * 50_000 + " at " * 20_000
    assert pii.all_spans(text, pii.base_spans(text), {}) == []


def _person(i):
    return f"word word mail user{i}@site{i % 7}.example.com and +1 (555) 555-{1000 + i} text {10 + i % 200}.20.30.{i % 250} end"


def test_personal_data(make_docs):
    rows = [(i, _person(i)) for i in range(120)] + [(i, f"numbers {i}234567 and 99999{i} and 1.2.3 {i}") for i in range(120, 240)]
    rows += [(500, "call (555) 555-1234 now, mail me @ home"), (501, None), (502, ""), (None, _person(1)), (3, _person(3))]
    docs = make_docs(rows)
    got = pii.find_personal_data(docs).collect()
    assert len(got) == len(rows)
    texts = dict(rows[:120])
    for r in got:
        if r.doc_id in texts:
            spans = [(k, *map(int, s)) for k, *s in (x.split(":") for x in r.spans.split(","))]
            base = [(k, a, b) for k, v in plain_spans(texts[r.doc_id]).items() for a, b in v]
            assert set(base) <= set(spans)
            assert (r.n_email, r.n_ip, r.n_phone) == (1, 1, 1)
        if r.doc_id in (501, 502):
            assert (r.spans, r.n_added) == ("", 0)
        if r.doc_id is not None and 120 <= r.doc_id < 240:
            assert r.spans == ""
    redacted = {r.doc_id: r for r in pii.redact_documents(docs).collect()}
    assert redacted[501].text is None
    assert "[EMAIL]" in redacted[4].text and "@" not in redacted[4].text and redacted[4].source == "s"
    assert pii.find_personal_data(make_docs([])).count() == 0


def test_boosted_trees_separate_and_calibrate():
    rng = np.random.default_rng(1)
    x = rng.random((2_000, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.3)).astype(float)
    trees = pii.boost(x[:1_500], y[:1_500])
    score = trees.score(x[1_500:])
    assert ((score > 0.5) == (y[1_500:] > 0)).mean() > 0.97
    least = pii.calibrate(score, y[1_500:])
    assert y[1_500:][score >= least].mean() >= pii.MIN_PRECISION
    assert pii.calibrate(score, np.zeros(500)) == float("inf")


def test_redaction_covers_overlaps():
    assert pii.redact("abcdefgh", [("ip", 1, 4), ("card", 2, 6)]) == "a[IP]gh"


@pytest.fixture(scope="module")
def learned(spark):
    return pii.learn(spark.read.parquet(f"{SF}/documents.parquet"))


VARIANTS = {
    "jane.doe (at) example dot com": "email", "joe [at] mail.example.com": "email", "li_wei at river dot co dot uk": "email",
    "(555) 555-1234": "phone", "555-867-5309": "phone", "0049 555.867.5309": "phone", "4111/1111/1111/1111": "card",
    "5500_0000_0000_0004": "card", "10[.]20[.]30[.]4": "ip", "10 dot 20 dot 30 dot 4": "ip",
}


def test_every_kind_has_trees_and_adds_variants(spark, learned, make_docs):
    """Variants in the middle of a sentence are added and redacted, base spans and digests stay as they are."""
    assert set(learned) == set(pii.KINDS)
    rows = [(i, f"one of them said {v} and jane@example.com was there") for i, v in enumerate(VARIANTS)]
    got = {r.doc_id: r for r in pii.find_personal_data(make_docs(rows), learned).collect()}
    plain = {r.doc_id: r for r in pii.find_personal_data(make_docs(rows), {}).collect()}
    redacted = {r.doc_id: r.text for r in pii.redact_documents(make_docs(rows), learned).collect()}
    for i, (value, kind) in enumerate(VARIANTS.items()):
        assert f"{kind}:17:{17 + len(value)}" in got[i].spans and got[i].n_added == 1, (value, got[i].spans)
        assert got[i].base_sha256 == plain[i].base_sha256 and got[i].n_email == 1 and plain[i].n_added == 0
        assert redacted[i] == f"one of them said [{kind.upper()}] and [EMAIL] was there"


def test_held_out_variants_and_other_numbers(spark, learned):
    rng = random.Random(5)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 300").limit(200).collect()]
    found, wrong = dict.fromkeys(pii.KINDS, 0), 0
    for i in range(800):
        text = rng.choice(texts)
        at = rng.choice([k for k, c in enumerate(text) if c == " "]) + 1
        kind = pii.KINDS[i % 4]
        for value, right in ((pii.rewritten(kind, pii.made_value(kind, rng), rng), True), (pii.made_other(rng), False)):
            around = text[max(0, at - 100) : at] + value + " " + text[at : at + 100]
            a, base = min(at, 100), pii.base_spans(around)
            spans = [s for s in pii.all_spans(around, base, learned) if s[1] < a + len(value) and s[2] > a and s[1:] not in base[s[0]]]
            if right:
                found[kind] += (kind, a, a + len(value)) in spans
            else:
                wrong += bool(spans)
    assert all(n >= 180 for n in found.values()), found
    assert wrong <= 0.05 * sum(found.values())


def test_given_documents_are_left_alone(spark, learned):
    """The given texts hold base forms only; nothing is added to them."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    assert pii.find_personal_data(docs, learned).where("n_added > 0").count() <= 2


def test_examples_of_one_document_do_not_name_the_base_form():
    text = "write to jane@example.com or call +49 30 1234567 from 10.0.0.1 with 4111 1111 1111 1111 " * 3
    rows = pii.examples(text, random.Random(1))
    assert {k for k, right, _ in rows if right} == set(pii.KINDS) and {right for _, right, _ in rows} == {True, False}
    assert pii.examples("", random.Random(1)) == []
