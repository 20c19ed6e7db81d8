"""Byte-level BPE: ranked merges folded over the byte arrays of distinct words.

A text is cut into words by the vocabulary's split pattern, each distinct word
of a task is encoded once by folding merges in rank order, and the ids of a
document are its words' ids in order. Decoding concatenates the binary pieces
of the ids.

The pattern is the one published with the vocabulary: contractions, runs of
letters, numbers or other signs with one space before them, and white space.
``word_starts`` applies it to the code points of many texts at once. The merge
fold runs over all new words of a slice together: in each step every word
merges its lowest-ranked pair.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpath.llm.common import batch_slices, ragged_take, text_slices

PAIR_SHIFT = 20
NO_RANK = np.int32(2**31 - 1)
#: Words of more bytes are merged one by one with a heap.
WIDE_WORD = 64
#: Word memo entries per task before the memo starts anew.
MEMO_WORDS = 250_000

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
APOSTROPHE, BLANK = 0x27, 0x20
#: An odd number, so that its powers have inverses modulo 2**64.
HASH_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def char_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number, other."""
    import regex

    every = "".join(map(chr, [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]))
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            table[ord(m.group()[0]) : ord(m.group()[-1]) + 1] = kind
    table[0xD800:0xE000] = OTHER
    return table


def merge_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (left id, right id) keys of every pair whose joined bytes have a rank, and that rank."""
    keys, joined = [], []
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if a is not None and b is not None:
                keys.append(a << PAIR_SHIFT | b)
                joined.append(rank)
    order = np.argsort(np.array(keys, np.int64))
    return np.array(keys, np.int64)[order], np.array(joined, np.int32)[order]


def word_starts(cp: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Flags the code points at which a word starts; ``first`` flags the first one of each text."""
    n = len(cp)
    if not n:
        return np.zeros(0, bool)
    kind = classes[cp]
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    # a word after white space takes one blank along; other white space stands alone
    after = np.flatnonzero(run & ~first & (kind != SPACE))
    after = after[kind[after - 1] == SPACE]
    start[after - 1] = True
    start[after] = cp[after - 1] != BLANK
    # contractions: an apostrophe that starts a word, alone before letters
    sign = np.flatnonzero((cp == APOSTROPHE) & start)
    sign = sign[sign + 1 < n]
    sign = sign[run[sign] & run[sign + 1] & ~first[sign + 1] & (kind[sign + 1] == LETTER)]
    if len(sign):
        one = cp[sign + 1]
        same = np.zeros(len(sign), bool)
        two = np.zeros(len(sign), np.uint32)
        inside = sign + 2 < n
        same[inside] = ~run[sign[inside] + 2]
        two[inside] = cp[sign[inside] + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = same & (
            ((one == ord("r")) & (two == ord("e")))
            | ((one == ord("v")) & (two == ord("e")))
            | ((one == ord("l")) & (two == ord("l")))
        )
        start[sign[short | long] + 1] = False
        ends = np.concatenate([sign[short] + 2, sign[long] + 3])
        start[ends[ends < n]] = True
    return start


class Encoder:
    """Encodes many texts of one task; holds the memo of distinct words."""

    def __init__(self, ranks: dict[bytes, int], pairs: tuple[np.ndarray, np.ndarray], classes: np.ndarray):
        self.ranks, self.classes = ranks, classes
        self.keys, self.joined = pairs
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pieces = dict(zip(ranks.values(), ranks.keys()))
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair; negative ids stand for no token."""
        key = a.astype(np.int64) << PAIR_SHIFT | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == key), self.joined[at], NO_RANK)

    def _fold(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merges all words together, one pair of each word a step; flat ids and counts.

        ``token`` holds the tokens of all unfinished words in a row, ``rank``
        the rank of each with the next token of its word.
        """
        token = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        rank = np.full(len(token), NO_RANK)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self._rank(token[inner], token[inner + 1])
        done_token, done_word = [], []
        while len(token):
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(begin, len(token)))
            best = np.minimum.reduceat(rank, begin)
            over = np.repeat(best == NO_RANK, size)
            if over.any():
                done_token.append(token[over])
                done_word.append(word[over])
                token, word, rank = token[~over], word[~over], rank[~over]
                size, best = size[best != NO_RANK], best[best != NO_RANK]
                if not len(token):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]  # the first of each word
            token[at] = best
            keep = np.ones(len(token), bool)
            keep[at + 1] = False
            token, word, rank = token[keep], word[keep], rank[keep]
            at = at - np.arange(len(at))
            rank[at] = NO_RANK
            right = at[at + 1 < len(token)]
            right = right[word[right] == word[right + 1]]
            rank[right] = self._rank(token[right], token[right + 1])
            left = at[at > 0] - 1
            left = left[word[left] == word[left + 1]]
            rank[left] = self._rank(token[left], token[left + 1])
        if not done_token:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word = np.concatenate(done_word)
        return np.concatenate(done_token)[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def _fold_wide(self, word: bytes) -> np.ndarray:
        """The same merges for one long word: a linked list of tokens and a heap of ranked pairs."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        n = len(ids)
        first = self._rank(ids[:-1], ids[1:])
        token = ids.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(r), i, token[i], token[i + 1]) for i, r in enumerate(first.tolist()) if r != NO_RANK]
        heapq.heapify(heap)
        pieces, ranks = self.pieces, self.ranks
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j >= n or token[j] != b:
                continue  # one of the two has been merged meanwhile
            token[i], token[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := ranks.get(pieces[r] + pieces[token[k]])) is not None:
                    heapq.heappush(heap, (x, i, r, token[k]))
            if (h := before[i]) >= 0 and (x := ranks.get(pieces[token[h]] + pieces[r])) is not None:
                heapq.heappush(heap, (x, h, token[h], r))
        return np.array([t for t in token if t >= 0], np.int32)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word, concatenated, and their counts."""
        kind = np.fromiter((w in self.ranks or 2 * (len(w) > WIDE_WORD) for w in words), np.int8, len(words))
        whole, wide, other = (np.flatnonzero(kind == k) for k in (1, 2, 0))
        long = [self._fold_wide(words[i]) for i in wide]
        flat, counts = self._fold([words[i] for i in other])
        parts = [np.fromiter((self.ranks[words[i]] for i in whole), np.int32, len(whole)), *long, flat]
        sizes = np.concatenate([np.ones(len(whole), np.int64), np.array([len(x) for x in long], np.int64), counts])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        place = np.empty(len(words), np.int64)
        place[np.concatenate([whole, wide, other])] = np.arange(len(words))
        return ragged_take(np.concatenate(parts).astype(np.int32), offsets, place)

    def _learn(self, words: list[str]) -> None:
        flat, counts = self.encode_words([w.encode() for w in words])
        self.memo.update(zip(words, range(len(self.memo), len(self.memo) + len(words))))
        self.flat = np.concatenate([self.flat, flat])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(counts)])

    def _distinct(self, chars: str, cp: np.ndarray, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Distinct words and, for each word of the slice, which of them it is.

        Words are grouped by a rolling hash; each is then compared, code point
        by code point, with the first of its group.
        """
        ends = np.append(starts[1:], len(cp))
        powers = np.full(len(cp) + 1, HASH_BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        total = np.concatenate([[np.uint64(0)], np.cumsum((cp + np.uint32(1)) * powers[:-1], dtype=np.uint64)])
        inverse = np.uint64(pow(int(HASH_BASE), -1, 1 << 64))
        unshift = np.full(len(cp) + 1, inverse, np.uint64)
        unshift[0] = 1
        np.multiply.accumulate(unshift, out=unshift)
        hashed = (total[ends] - total[starts]) * unshift[starts]
        _, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        size = ends - starts
        same = bool((size == size[first][which]).all())
        if same:
            at = np.arange(len(cp))  # the words follow each other without gaps
            same = bool((cp == cp[at + np.repeat(starts[first][which] - starts, size)]).all())
        if same:
            return [chars[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())], which
        words: dict[str, int] = {}
        which = [words.setdefault(chars[i:j], len(words)) for i, j in zip(starts.tolist(), ends.tolist())]
        return list(words), np.array(which)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        for a, b in text_slices(texts):
            yield from self._encode_slice(texts[a:b])

    def _encode_slice(self, texts: list[str]) -> Iterator[np.ndarray]:
        chars = "".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        cp = np.frombuffer(chars.encode("utf-32-le"), np.uint32)
        begins = np.cumsum(sizes) - sizes
        first = np.zeros(len(cp), bool)
        first[begins[sizes > 0]] = True
        if not len(cp):
            yield from (np.zeros(0, np.int32) for _ in texts)
            return
        starts = np.flatnonzero(word_starts(cp, first, self.classes))
        words, which = self._distinct(chars, cp, starts)
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        new = [w for w in words if w not in self.memo]
        if new:
            self._learn(new)
        rows = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))[which]
        flat, counts = ragged_take(self.flat, self.offsets, rows)
        ends = np.concatenate([[0], np.cumsum(counts)])
        # words before each text's end, hence ids before it
        upto = ends[np.searchsorted(starts, begins + sizes)]
        low = 0
        for high in upto.tolist():
            yield flat[low:high]
            low = high

    def decode(self, ids: np.ndarray) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids.tolist()])


class Vocabulary:
    """Rank file, merge table and character classes, broadcast once; their size is the vocabulary's."""

    def __init__(self, spark, path: str):
        ranks = read_ranks(path)
        self.shared = spark.sparkContext.broadcast((ranks, merge_table(ranks), char_classes()))

    def encoder(self) -> Encoder:
        return Encoder(*self.shared.value)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids (array<int>) and the bytes that decoding gives.

    A null text counts as the empty one and has no ids. Repeated rows stay.
    Other columns are not read.
    """
    vocabulary = Vocabulary(docs.sparkSession, path)

    def run(batches):
        encoder = vocabulary.encoder()
        for batch in batches:
            ids = [x for _, _, texts in batch_slices(batch) for x in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([encoder.decode(x) for x in ids], pa.binary()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """Token count and sha256 of the ids and of the decoded bytes, computed where the ids are made."""
    vocabulary = Vocabulary(docs.sparkSession, path)

    def run(batches):
        encoder = vocabulary.encoder()
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for _, _, texts in batch_slices(batch):
                for ids in encoder.encode(texts):
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(ids.astype("<u4")).hexdigest())
                    of_bytes.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
