"""Alignment against a plain walk over both token lists, with the published libraries' ids."""

import hashlib
from collections import Counter

import pytest
from docs_fixture import make_docs  # noqa: F401

from creditpath.llm import alignment as A
from creditpath.llm import queries as Q


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(Q.vocabulary_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=Q.PIECES)


def brute(rows, tokenizers):
    a_side, b_side = tokenizers
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}
    names = {i: t for t, i in a_side.get_vocab().items()}

    def of_a(i):
        return bytes(byte[c] for c in names[i])

    def of_b(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    def placed(ids, of):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(of(i)), i))
            at = out[-1][1]
        return out

    per, count = [], Counter()
    for doc, text in rows:
        raw = (" " + text).encode() if text else b""
        a = placed(a_side.encode(" " + text, add_special_tokens=False).ids, of_a) if text else []
        b = placed(b_side.encode(text), of_b) if text else []
        if not text or b"".join(of_a(i) for *_, i in a) != raw or b"".join(of_b(i) for *_, i in b) != raw:
            a = b = []
        links = [(x, y) for s, e, x in a for t, f, y in b if t < e and s < f] if len(a) < 400 else None
        ends = sorted({e for _, e, _ in a} & {f for _, f, _ in b})
        groups, low = [], 0
        for end in ends:
            groups.append([[i for s, e, i in side if low <= s and e <= end] for side in (a, b)])
            low = end
        count.update(links)
        text_of = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        per.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(text_of.encode()).hexdigest() if groups else ""))
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return count, [
        (doc, n_a, n_b, g, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), h)
        for doc, n_a, n_b, g, links, h in per
    ]


ODD = [
    (1, None), (2, ""), (3, " leading  two  spaces"), (4, "tab\there\nnew\r\n line"), (5, "emoji \U0001f600 ẞ ﬁ １２   x"),
    (6, "<|endoftext|> <s> </s> <unk>"), (7, "\x00null\x01"), (None, "no id here"), (7, "\x00null\x01"), (8, "▁ under"),
    (9, "a" * 900), (10, " "), (11, "﻿bom zero​width"), (12, "é combining"), (13, "the cat and the dog, the end of the cat"),
]


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))


def test_odd_texts(make_docs, tokenizers):
    count, expected = brute(ODD, tokenizers)
    found = A.align(make_docs(ODD).repartition(3), Q.RANKS, Q.PIECES)
    assert order(found.documents.collect()) == order(expected)
    pairs = {(r.a_id, r.b_id): r for r in found.pairs.collect()}
    assert {k: r.n_links for k, r in pairs.items()} == count
    assert all(r.is_best == (r.n_links == max(n for (_, y), n in count.items() if y == b)) for (_, b), r in pairs.items())


def test_given_documents(spark, tokenizers, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 800")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    _, expected = brute(rows, tokenizers)
    monkeypatch.setattr(A, "SLICE_CHARS", 2000)
    assert order(A.align(docs, Q.RANKS, Q.PIECES).documents.collect()) == order(expected)


def test_empty_table(make_docs):
    found = A.align(make_docs([]), Q.RANKS, Q.PIECES)
    assert found.documents.collect() == [] and found.pairs.collect() == []
