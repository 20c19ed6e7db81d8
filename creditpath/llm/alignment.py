"""Alignment of two tokenizers over a corpus: which token of B each token of A overlaps, and how often.

A is byte-level BPE over a space and the text, B a sentencepiece model over the
text (it adds the space). Byte offsets where tokens of both end cut a text into
groups; inside a group every A-B pair of tokens whose bytes overlap is a link.
No inner end is shared, so the links of a group are its stretches between ends
of either side.

**Fast path.** An array of A's vocabulary gives the B id with the same bytes. A
group of one A and one B token that agree with it is counted at the A id, in a
vector as long as the vocabulary. Only links of other groups are counted as
pairs, and only those pass the shuffle by pair.

A first pass encodes the texts, once, and writes per slice of documents (some
SLICE_CHARS characters) what the second needs: counts, hashes, and for each
document its regular ids and irregular pairs with their numbers. After the
counting, each slice asks for the totals of its distinct irregular pairs; a
frequent pair is asked for once a slice. Vectors of the vocabularies' lengths
are all that is broadcast or sent to the driver.

A null or empty text, and one whose joined tokens of A or B aren't the bytes of
a space and the text, has no tokens: zeros, and an empty hash. Special tokens'
strings are ordinary text. Repeated rows count each; ids may be null; an empty
table gives empty results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpath.config import shared_dir
from creditpath.llm.bpe import Vocabulary
from creditpath.llm.common import Shared, cut, ragged_take, text_slices

#: Characters of text whose documents share a written slice.
SLICE_CHARS = 1 << 22
B_BITS = 20
MISSING = -1


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def piece_bytes(model: bytes) -> list[bytes]:
    """Bytes of each piece of a sentencepiece model; control and unknown pieces stand for none that occur in texts."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


def same_bytes(a: list[bytes], b: list[bytes], spelled: np.ndarray) -> np.ndarray:
    """B id with the bytes of each A id, else MISSING; of several the one that isn't a mere byte."""
    of = {}
    for i in sorted(range(len(b)), key=lambda i: (not spelled[i], i), reverse=True):
        of[b[i]] = i
    return np.array([of.get(x, MISSING) for x in a], np.int64)


class Table:
    """Tokens' bytes in one array."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(self.size)])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return ragged_take(self.flat, self.offsets, ids)[0]


class Digits:
    """Decimal ids with a sign behind each, as text of many ids at once."""

    def __init__(self, n: int):
        self.width = len(str(n))
        ids = np.arange(n)
        self.size = np.char.str_len(ids.astype(str)).astype(np.int64)
        self.text = np.char.encode(ids.astype(str), "ascii").astype(f"S{self.width}").view(np.uint8).reshape(n, self.width)

    def spelled(self, ids: np.ndarray, signs: np.ndarray) -> bytes:
        out = np.zeros((len(ids), self.width + 1), np.uint8)
        out[:, : self.width] = self.text[ids]
        out[:, self.width] = signs
        return out[out != 0].tobytes()


@dataclass
class Aligned:
    """A slice's links (document, A id, B id, regular or not) and each document's counts and hash."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    link_doc: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    regular: np.ndarray


class Aligner:
    def __init__(self, a_tokens: list[bytes], b_tokens: list[bytes], identity: np.ndarray):
        self.a, self.b, self.identity = Table(a_tokens), Table(b_tokens), identity
        self.digits = Digits(max(len(a_tokens), len(b_tokens)))

    def _fitting(self, raw: list[bytes], ids: list[np.ndarray], table: Table) -> np.ndarray:
        """Flags texts whose tokens join to their bytes."""
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        flat = np.concatenate(ids)
        fits = np.bincount(doc, table.size[flat], len(raw)).astype(np.int64) == sizes
        if not fits.any():
            return fits
        told = table.joined(flat[fits[doc]])
        given = np.frombuffer(b"".join(x for x, f in zip(raw, fits) if f), np.uint8)
        at = np.flatnonzero(fits)
        wrong = np.repeat(at, sizes[at])[told != given]
        fits[wrong] = False
        return fits

    def align(self, raw: list[bytes], a_ids: list[np.ndarray], b_ids: list[np.ndarray]) -> Aligned:
        """``raw`` holds a space and the text; an empty one has no tokens."""
        fits = self._fitting(raw, a_ids, self.a) & self._fitting(raw, b_ids, self.b)
        none = np.zeros(0, np.int64)
        a_ids = [x if f else none for x, f in zip(a_ids, fits)]
        b_ids = [x if f else none for x, f in zip(b_ids, fits)]
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        a, b = np.concatenate([none, *a_ids]), np.concatenate([none, *b_ids])
        a_end, b_end = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        n = int(a_end[-1]) if len(a_end) else 0
        a_ends, b_ends = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        a_ends[a_end], b_ends[b_end] = True, True
        both = np.cumsum(a_ends & b_ends) - (a_ends & b_ends)  # groups that ended before
        a_group, b_group = both[a_end], both[b_end]
        n_groups = int(a_group[-1]) + 1 if len(a) else 0
        a_in, b_in = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
        doc_of_group = np.zeros(n_groups, np.int64)
        doc_of_group[a_group] = np.repeat(np.arange(len(raw)), n_a)
        # links: a stretch between ends lies in one token of each side
        at = np.flatnonzero(a_ends | b_ends)
        link_a = a[(np.cumsum(a_ends) - a_ends)[at]] if len(at) else none
        link_b = b[(np.cumsum(b_ends) - b_ends)[at]] if len(at) else none
        group = both[at]
        regular = (a_in[group] == 1) & (b_in[group] == 1) & (self.identity[link_a] == link_b)
        doc = doc_of_group[group]
        return Aligned(
            n_a, n_b, np.bincount(doc_of_group, minlength=len(raw)), np.bincount(doc, minlength=len(raw)),
            self._hashes(a, b, a_group, b_group, a_in, b_in, n_a, n_b), doc, link_a, link_b, regular,
        )

    def _hashes(self, a, b, a_group, b_group, a_in, b_in, n_a, n_b) -> list[str]:
        """sha256 of each document's groups, spelled out for the whole slice at once."""
        a_upto, b_upto = np.cumsum(a_in), np.cumsum(b_in)
        ids, signs = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        a_at = np.arange(len(a)) + (b_upto - b_in)[a_group]
        b_at = np.arange(len(b)) + a_upto[b_group]
        ids[a_at], ids[b_at] = a, b
        signs[a_at[a_upto - 1]] = ord("|")
        signs[b_at[b_upto - 1]] = ord(";")
        tokens = np.cumsum(n_a + n_b)
        signs[tokens[tokens > 0] - 1] = 0  # none behind a document's last
        text = self.digits.spelled(ids, signs)
        ends = np.concatenate([[0], np.cumsum(self.digits.size[ids] + (signs > 0))])[tokens].tolist()
        return [hashlib.sha256(text[i:j]).hexdigest() if j > i else "" for i, j in zip([0, *ends[:-1]], ends)]


def numbered(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, key) rows and how often each occurs."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])) if len(doc) else doc[:0]
    return doc[first], key[first], np.diff(np.append(first, len(doc)))


def packed(*columns: np.ndarray) -> bytes:
    return b"".join(c.astype("<u4").tobytes() for c in columns)


def unpacked(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, "<u4").reshape(n, -1).astype(np.int64)


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
SLICES = (
    "slice long, doc_id array<long>, "
    + ", ".join(f"{c} array<long>" for c in COUNTS)
    + ", groups_sha256 array<string>, regular binary, irregular binary"
)


@dataclass
class Alignment:
    """``pairs``: a_id, b_id, n_links, is_best (the most frequent of its B id, ties included); ``documents``: a row each."""

    pairs: DataFrame
    documents: DataFrame


def align(docs: DataFrame, ranks_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> Alignment:
    """Aligns the byte-level BPE of ``ranks_path`` (A) with the sentencepiece model of ``piece_path`` (B)."""
    import sentencepiece

    spark = docs.sparkSession
    vocabulary = Vocabulary(spark, ranks_path)
    encoder = vocabulary.encoder()
    a_tokens = [encoder.pieces.get(i, b"") for i in range(max(encoder.pieces) + 1)]
    model = read_file(piece_path)
    b_tokens = piece_bytes(model)
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    spelled = np.array([not processor.is_byte(i) for i in range(len(b_tokens))])
    identity = same_bytes(a_tokens, b_tokens, spelled)
    tables = Shared(spark, (Aligner(a_tokens, b_tokens, identity), model))

    def encode(batches):
        tool, proto = tables.value
        a_side, b_side = vocabulary.encoder(), sentencepiece.SentencePieceProcessor(model_proto=proto)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for low, high in text_slices(texts, SLICE_CHARS):
                parts = []
                for i, j in text_slices(texts[low:high]):
                    some = texts[low + i : low + j]
                    a_ids = list(a_side.encode([" " + t if t else "" for t in some]))
                    b_ids = [np.array(x, np.int64) for x in b_side.encode(some, num_threads=1)]
                    parts.append((i, tool.align([(" " + t).encode() if t else b"" for t in some], a_ids, b_ids)))
                yield slice_row(number, batch.column("doc_id").slice(low, high - low), parts)
                number += 1

    def slice_row(number: int, ids: pa.Array, parts: list[tuple[int, Aligned]]) -> pa.RecordBatch:
        doc, a, b, regular = (
            np.concatenate(x) for x in zip(*((p.link_doc + at, p.link_a, p.link_b, p.regular) for at, p in parts))
        )
        irregular = numbered(doc[~regular], a[~regular] << B_BITS | b[~regular])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number]),
                pa.ListArray.from_arrays([0, len(ids)], ids),
                *(pa.array([np.concatenate([getattr(p, c) for _, p in parts])], pa.list_(pa.int64())) for c in COUNTS),
                pa.array([[h for _, p in parts for h in p.groups]]),
                pa.array([packed(*numbered(doc[regular], a[regular]))], pa.binary()),
                pa.array(
                    [packed(irregular[0], irregular[1] >> B_BITS, irregular[1] & (1 << B_BITS) - 1, irregular[2])], pa.binary()
                ),
            ],
            names=["slice", "doc_id", *COUNTS, "groups_sha256", "regular", "irregular"],
        )

    path = shared_dir(spark, "alignment")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows.mapInArrow(encode, SLICES).write.option("compression", "zstd").parquet(path)
    slices = spark.read.schema(SLICES).parquet(path)

    def count_regular(batches):
        """Regular groups of a task, in a vector as long as A's vocabulary."""
        total = np.zeros(len(identity), np.int64)
        for batch in batches:
            for blob in batch.column("regular"):
                _, a, n = unpacked(blob.as_py(), 3)
                total += np.bincount(a, n, len(total)).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(identity[used]), pa.array(total[used])], names=["a_id", "b_id", "n"])

    def count_pairs(batches):
        for batch in batches:
            for blob in batch.column("irregular"):
                _, a, b, n = unpacked(blob.as_py(), 4)
                key, which = np.unique(a << B_BITS | b, return_inverse=True)
                total = np.bincount(which, n, len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key >> B_BITS), pa.array(key & (1 << B_BITS) - 1), pa.array(total)], names=["a_id", "b_id", "n"]
                )

    schema = "a_id long, b_id long, n long"
    # the vectors' sum has one row an A id, so it adds no more than that to the pairs
    vector = slices.select("regular").mapInArrow(count_regular, schema).groupBy("a_id", "b_id").agg(F.sum("n").alias("n"))
    irregular = slices.select("irregular").mapInArrow(count_pairs, schema)
    total = cut(irregular.unionByName(vector).groupBy("a_id", "b_id").agg(F.sum("n").alias("n_links")))
    best = total.groupBy("b_id").agg(F.max("n_links").alias("best"))
    pairs = cut(
        total.join(F.broadcast(best), "b_id").select("a_id", "b_id", "n_links", (F.col("n_links") == F.col("best")).alias("is_best"))
    )
    # at most one row for each id of A
    known = spark.createDataFrame([(i, int(b)) for i, b in enumerate(identity) if b != MISSING], "a_id long, b_id long")
    of_identity = pairs.join(F.broadcast(known), ["a_id", "b_id"]).toArrow()
    count, is_best = np.zeros(len(identity), np.int64), np.zeros(len(identity), np.int64)
    at = of_identity.column("a_id").to_numpy()
    count[at], is_best[at] = of_identity.column("n_links").to_numpy(), of_identity.column("is_best").to_numpy()
    vectors = spark.sparkContext.broadcast((count, is_best))

    def ask(batches):
        for batch in batches:
            for number, blob in zip(batch.column("slice").to_pylist(), batch.column("irregular")):
                _, a, b, _ = unpacked(blob.as_py(), 4)
                key = np.unique(a << B_BITS | b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), number)), pa.array(key >> B_BITS), pa.array(key & (1 << B_BITS) - 1)],
                    names=["slice", "a_id", "b_id"],
                )

    asked = slices.select("slice", "irregular").mapInArrow(ask, "slice long, a_id long, b_id long")
    told = asked.join(pairs, ["a_id", "b_id"]).groupBy("slice").agg(F.collect_list(F.struct("a_id", "b_id", "n_links", "is_best")).alias("told"))

    def finish(batches) -> Iterator[pa.RecordBatch]:
        count, is_best = vectors.value
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                ids = row.column("doc_id").flatten()
                n = len(ids)
                doc, a, times = unpacked(row.column("regular")[0].as_py(), 3)
                n_best = np.bincount(doc, times * is_best[a], n).astype(np.int64)
                # sums are exact: whole numbers, added as such
                count_sum = np.zeros(n, np.int64)
                np.add.at(count_sum, doc, times * count[a])
                doc, a, b, times = unpacked(row.column("irregular")[0].as_py(), 4)
                if len(doc):
                    known = row.column("told").flatten()
                    key = known.field("a_id").to_numpy() << B_BITS | known.field("b_id").to_numpy()
                    order = np.argsort(key)
                    at = order[np.searchsorted(key, a << B_BITS | b, sorter=order)]
                    n_best += np.bincount(doc, times * known.field("is_best").to_numpy(zero_copy_only=False)[at], n).astype(np.int64)
                    np.add.at(count_sum, doc, times * known.field("n_links").to_numpy()[at])
                yield pa.RecordBatch.from_arrays(
                    [ids, *(row.column(c).flatten() for c in COUNTS), pa.array(n_best), pa.array(count_sum), row.column("groups_sha256").flatten()],
                    names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"],
                )

    out = f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, n_best long, count_sum long, groups_sha256 string"
    return Alignment(pairs, slices.join(told, "slice", "left").mapInArrow(finish, out))
