"""Byte-level BPE and packing against the public tokenizer libraries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from docs_fixture import make_docs  # noqa: F401
import tiktoken

from creditpath.llm import bpe, packing
from creditpath.llm.queries import RANKS

TEXTS = [None, "", " ", "a", "don't we'll they've 're 'S", "  two  blanks \n\n\t x", "été 日本語 ١٢٣ ½ 😀\x1c\x85\xa0​", "a" * 20_000, " " * 5_000, "<|endoftext|>", "x" * 63 + " " + "y" * 65]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    ranks = bpe.read_ranks(RANKS)
    return bpe.Encoder(ranks, bpe.merge_table(ranks), bpe.char_classes())


def test_random_texts_match_the_library(encoder, reference):
    random.seed(5)
    parts = ["'", "s", "t", "re", "ll", "ve", "m", "d", " ", "  ", "\n", "\t", "a", "é", "1", "٣", "½", "。", "\u3000", "\x1c", "\x85", "\xa0", "\u200b", "😀", "the", "!", "\x00", "中"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 25))) for _ in range(5_000)]
    assert [x.tolist() for x in encoder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_colliding_hashes_are_told_apart(encoder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "HASH_BASE", np.uint64(1))  # words of equal letters then hash alike
    texts = ["abc cab bca", "tac cat act"]
    fresh = bpe.Encoder(encoder.ranks, (encoder.keys, encoder.joined), encoder.classes)
    assert [x.tolist() for x in fresh.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_digests_and_round_trip(make_docs, reference):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "a"), (None, "b")]
    got = bpe.digest_documents(make_docs(rows), RANKS).collect()
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((i, len(ids), digest, hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_ids_and_pieces(make_docs):
    row = bpe.encode_documents(make_docs([(1, "don't")]), RANKS).first()
    assert bytes(row.decoded) == b"don't" and len(row.ids) == 2


def test_empty_table(make_docs):
    assert bpe.digest_documents(make_docs([]), RANKS).count() == 0
    assert packing.pack(make_docs([]), RANKS).count() == 0


def test_fullest_window_matches_brute_force():
    random.seed(2)
    for _ in range(200):
        window = random.randint(5, 40)
        counts = {random.randint(1, window): random.randint(1, 4) for _ in range(random.randint(1, 5))}
        best = max(x for x in _sums(counts) if x <= window)
        chosen = packing._fullest(counts, window)
        assert sum(k * n for k, n in chosen.items()) == best
        assert all(n <= counts[k] for k, n in chosen.items())


def _sums(counts):
    sums = {0}
    for k, n in counts.items():
        sums = {s + k * i for s in sums for i in range(n + 1)}
    return sums


def test_packing_places_every_id_once(make_docs, reference):
    random.seed(4)
    rows = [(i, " ".join(random.choices(["one", "two", "three"], k=random.choice([1, 3, 40, 900, 2500])))) for i in range(120)]
    rows += [(None, None), (7, ""), (7, ""), (200, "z" * 9_000)]
    got = packing.pack(make_docs(rows), RANKS).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[(r.doc_id, r.doc_tokens)].append(r)
    for i, t in rows:
        ids = np.array([*reference.encode_ordinary(t or ""), 0], "<u4")
        own = by_doc[(i, len(ids))]
        assert {r.start for r in own} == set(range(0, len(ids), packing.WINDOW))
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    total = sum(len(reference.encode_ordinary(t or "")) + 1 for _, t in rows)
    assert sum(r.length for r in got) == total
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert len(sequences) <= 1.05 * -(-total // packing.WINDOW)


def test_tokenizers_library_gives_the_same_ids(encoder):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [x or "" for x in TEXTS]
    assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_higher_order_functions_give_the_same_ids(spark, reference):
    from pyspark.sql import functions as F

    from creditpath.llm import bpe_native

    random.seed(9)
    words = sorted({" " * random.randint(0, 1) + "".join(random.choices("etaoinsé日", k=random.randint(1, 7))) for _ in range(60)})
    rows = [(bytearray(w.encode()),) for w in [*words, ""]] + [(None,)]
    got = bpe_native.encode_distinct_words(spark.createDataFrame(rows, "word binary"), RANKS).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == (None if r.word is None else reference.encode_ordinary(bytes(r.word).decode()))
    ids = reference.encode_ordinary("don't 日本 x")
    one = spark.createDataFrame([(ids,)], "ids array<int>").select(bpe_native.decode_ids(F.col("ids"), RANKS).alias("b")).first()
    assert bytes(one.b).decode() == "don't 日本 x"
