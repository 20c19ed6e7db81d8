"""Removal of repeated byte strings by suffix sorting, over a whole corpus.

A byte goes if a string of ``length`` bytes that covers it also starts earlier:
in a document that comes before, or earlier in the same one.

**Buckets.** Every string of ``length`` bytes has an anchor, the first of its
32-byte grams with the smallest hash. Equal strings have equal anchors, and
strings that follow each other mostly share theirs, so all strings around one
anchor travel as one segment of some 134 bytes. Segments of one anchor form a
bucket. First only hashes travel: of equal segments the first occurrence stays,
the others are marked as repeated, and a bucket with a single occurrence is
done. Segments are equal if the 64-bit hashes of their anchor and of their
bytes both agree.

**Suffix sort.** The bytes of the segments left are fetched and dealt by bucket.
A task sorts the suffixes of whole buckets by the two-stage method
(``suffix_sort``) and takes the common prefix of neighbours: a run of neighbours
with ``length`` bytes in common is one string, and all of its places but the
first are marked.

**Hot anchors** (over one in 2^18 of all, and over ``hot`` times) would make
large buckets. Their strings stand as segments of their own, under a hash of
their bytes, so that each such bucket holds equal strings only, of which a task
passes on one. The list of hot anchors has 2^18 entries at most.

Rows and ties: documents come in the order of their ids, null ids last, those
of one id by a hash of their texts. Repeated rows (same id and text) are one
document, and each gets its result. A null text counts as empty; texts shorter
than ``length`` keep all bytes. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpath.config import default_partitions
from creditpath.llm.common import Shared, cut
from creditpath.llm.suffix_sort import Segments, common_prefixes, suffix_array

LENGTH = 100
GRAM = 32
#: Bytes that are hashed at once; longer texts are taken in overlapping pieces.
SLICE_BYTES = 1 << 20
#: Text whose segments share one bin of the shuffle.
BIN_BYTES = 1 << 25
MIN_BINS = 16
#: Segments are sorted in this many times as many bins.
SORT_BINS = 4
#: Bytes of segments that are sorted at once; a bucket is never split.
SORT_BYTES = 1 << 20
HOT = 1 << 16
HOT_BITS = 18
#: Documents of a batch, so that a document's number in it has 16 bits.
BATCH_ROWS = 1 << 16

BASE_GRAM = 0x9E3779B97F4A7C15
BASE_SEGMENT = 0xD6E8FEB86659FD93
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x = x * U(BASE_SEGMENT)
    x = x ^ (x >> U(29))
    x = x * U(BASE_GRAM)
    return x ^ (x >> U(32))


class Rolling:
    """Hashes of any substrings of a slice: differences of running sums, shifted back to the substring's start."""

    def __init__(self, base: int):
        self.base = U(base)
        self.inverse = U(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, U)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data) + 1:
            self.up, self.down = (np.full(len(data) + 1, b, U) for b in (self.base, self.inverse))
            for x in (self.up, self.down):
                x[0] = 1
                np.multiply.accumulate(x, out=x)
        out = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * self.up[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


class Cutter:
    """Segments of texts: anchor hash, segment hash, document, start, and number of strings that start in it."""

    def __init__(self, length: int, hot: np.ndarray):
        self.length, self.gram = length, min(GRAM, length)
        self.hot = hot
        self.grams, self.whole = Rolling(BASE_GRAM), Rolling(BASE_SEGMENT)

    def pieces(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Slices as (bytes, document of each text, its first byte in the slice and in its document)."""
        begins = np.concatenate([[0], ends[:-1]])
        doc = 0
        while doc < len(ends):
            if ends[doc] - begins[doc] > SLICE_BYTES:
                step = SLICE_BYTES - self.length + 1
                for at in range(int(begins[doc]), int(ends[doc]) - self.length + 1, step):
                    part = data[at : min(at + SLICE_BYTES, int(ends[doc]))]
                    yield part, np.array([doc]), np.array([0]), np.array([at - begins[doc]])
                doc += 1
                continue
            last = max(doc + 1, int(np.searchsorted(ends, begins[doc] + SLICE_BYTES, "right")))
            rows = np.arange(doc, last)
            yield data[begins[doc] : ends[last - 1]], rows, begins[rows] - begins[doc], np.zeros(len(rows), np.int64)
            doc = last

    def segments(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        for part, name, rows, begin, skipped, low, high in self.anchored(data, ends):
            sums = self.whole.sums(part)
            if len(self.hot):
                is_hot = np.isin(name, self.hot)
                count = (high - low + 1)[is_hot]
                ends_at = np.cumsum(count)
                single = np.arange(int(count.sum())) + np.repeat(low[is_hot] - (ends_at - count), count)
                own = mix(self.whole.between(sums, single, single + self.length))
                name = np.concatenate([name[~is_hot], mix(own ^ np.repeat(name[is_hot], count))])
                low, high = np.concatenate([low[~is_hot], single]), np.concatenate([high[~is_hot], single])
            digest = mix(self.whole.between(sums, low, high + self.length) + (high - low).astype(U))
            text = np.searchsorted(begin, low, "right") - 1
            yield name, digest, rows[text], low - begin[text] + skipped[text], high - low + 1

    def anchored(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Slices, and in each the strings around one anchor: its hash, the first and the last start."""
        for part, rows, begin, skipped in self.pieces(data, ends):
            n, length = len(part), self.length
            size = np.append(begin[1:], n) - begin
            long = size >= length
            if not long.any():
                continue
            sums = self.grams.sums(part)
            at = np.arange(n - self.gram + 1)
            hashed = mix(self.grams.between(sums, at, at + self.gram))
            # the smallest hash of each string's grams, the first of equal ones: a place in the low bits
            least = (hashed >> U(24) << U(24)) | at.astype(U)
            width, span = length - self.gram + 1, 1
            while 2 * span <= width:
                least = np.minimum(least[: len(least) - span], least[span:])
                span *= 2
            if span < width:
                more = width - span
                least = np.minimum(least[: len(least) - more], least[more:])
            step = np.zeros(len(least) + 1, np.int64)
            np.add.at(step, begin[long], 1)
            np.add.at(step, begin[long] + size[long] - length + 1, -1)
            start = np.flatnonzero(np.cumsum(step[:-1]))
            anchor = (least[start] & U((1 << 24) - 1)).astype(np.int64)
            new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
            first = np.flatnonzero(new)
            low, high = start[first], start[np.append(first[1:] - 1, len(start) - 1)]
            yield part, hashed[anchor[first]], rows, begin, skipped, low, high


def of_bin(name: np.ndarray, bins: int) -> np.ndarray:
    return (mix(name ^ U(BASE_GRAM)) % U(bins)).astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch's texts in a row and where each ends."""
    column = column.cast(pa.large_binary())
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    data = np.frombuffer(b"".join(x.as_buffer() for x in column if x.is_valid), np.uint8)
    return data, np.cumsum(sizes)


def row_groups(*keys: np.ndarray) -> np.ndarray:
    """Flags the first row of each group of rows with equal keys, in sorted arrays."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def packed_by_document(order: np.ndarray, key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Rows in the order of documents: the documents, and the columns' numbers of each as one binary of 64-bit numbers."""
    by = np.lexsort((columns[0], key, order))
    order, key = order[by], key[by]
    first = np.flatnonzero(row_groups(order, key))
    flat = np.stack([c[by].astype(np.int64) for c in columns], axis=1)
    edges = np.append(first, len(order)) * (8 * len(columns))
    data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(flat.tobytes())])
    return order[first], key[first], data.cast(pa.binary())


def as_ranges(order: np.ndarray, key: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of string starts, those that touch joined; ranges of a document don't overlap."""
    by = np.lexsort((low, key, order))
    order, key, low, high = order[by], key[by], low[by], high[by]
    new = row_groups(order, key)
    new[1:] |= low[1:] > high[:-1] + 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(new))[: len(first)] - 1
    return order[first], key[first], low[first], high[last]


class Blob:
    """Segments of one bin as bytes: arrays one after the other, with a table of their documents."""

    @staticmethod
    def pack(name, digest, row, start, count, order, key) -> bytes:
        docs, doc = np.unique(row, return_inverse=True)
        head = np.array([len(docs), len(name)], np.int64)
        parts = (head, order[docs], key[docs], name, digest, start.astype(np.uint32), doc.astype(np.uint16), count.astype(np.uint8))
        return b"".join(p.tobytes() for p in parts)

    @staticmethod
    def unpack(blob: bytes) -> tuple[np.ndarray, ...]:
        n_docs, n = np.frombuffer(blob, np.int64, 2).tolist()
        at, out = 16, []
        for kind, size in ((np.int64, n_docs), (np.int64, n_docs), (U, n), (U, n), (np.uint32, n), (np.uint16, n), (np.uint8, n)):
            out.append(np.frombuffer(blob, kind, size, at))
            at += size * np.dtype(kind).itemsize
        order, key, name, digest, start, doc, count = out
        return name, digest, order[doc], key[doc], start.astype(np.int64), count.astype(np.int64)


def first_of_equal(name, digest, order, key, start) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by segment and place, each place once, and flags of each bucket's and each segment's first."""
    by = np.lexsort((start, key, order, digest, name))
    by = by[row_groups(name[by], digest[by], order[by], key[by], start[by])]
    return by, row_groups(name[by]), row_groups(name[by], digest[by])


FOUND = "bin long, id_order long, id_hash long, kind int, data binary"


def found_rows(bin_, order, key, kind: int, data: pa.Array) -> pa.RecordBatch:
    n = len(data)
    whole = lambda x: pa.array(np.broadcast_to(np.asarray(x, np.int64), n))
    return pa.RecordBatch.from_arrays(
        [whole(bin_), whole(order), whole(key), pa.array(np.full(n, kind, np.int32)), data],
        names=["bin", "id_order", "id_hash", "kind", "data"],
    )


#: Kinds of rows that travel: segments of a bin, ranges of repeated strings, segments whose bytes are wanted.
SEGMENTS, RANGES, WANTED = 0, 1, 2


def documents_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id, its place in the order of ids, a hash of the text, and the text."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    last = F.lit((1 << 63) - 1)
    return named.select("doc_id", F.coalesce("doc_id", last).alias("id_order"), F.xxhash64("text").alias("id_hash"), "text")


def hot_anchors(rows: DataFrame, length: int, hot: int) -> tuple[np.ndarray, int]:
    """Anchors over one in 2^HOT_BITS of all and over ``hot`` times, and the bytes of all texts.

    An anchor that is that frequent in the whole table is so in some batch;
    only counts over that rate leave a batch.
    """

    def run(batches):
        cutter = Cutter(length, np.zeros(0, U))
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            names = [s[1] for s in cutter.anchored(data, ends)]
            name, count = np.unique(np.concatenate(names) if names else np.zeros(0, U), return_counts=True)
            total = int(count.sum())
            often = count >= max(8, total >> HOT_BITS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(name[often], U(0)).view(np.int64)),
                    pa.array(np.append(count[often], total)),
                    pa.array(np.append(np.zeros(int(often.sum()), np.int64), len(data))),
                ],
                names=["name", "n", "n_bytes"],
            )

    counts = cut(
        rows.select("text").mapInArrow(run, "name long, n long, n_bytes long")
        .groupBy("name", (F.col("n_bytes") > 0).alias("is_total")).agg(F.sum("n").alias("n"), F.sum("n_bytes").alias("n_bytes"))
    )
    total, n_bytes = counts.where("is_total").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    least = max(hot, total >> HOT_BITS)
    found = counts.where(~F.col("is_total") & (F.col("n") > least)).select("name").toArrow()
    return found.column("name").to_numpy().view(U), n_bytes


def repeated_segments(rows: DataFrame, length: int, cutter: Shared, bins: int) -> DataFrame:
    """Ranges of strings in segments that occurred before, and the segments to sort, by hashes alone."""

    def cut_batches(batches):
        tool = cutter.value
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                order, key = (batch.column(c).to_numpy() for c in ("id_order", "id_hash"))
                parts = list(tool.segments(*text_bytes(batch.column("text"))))
                if not parts:
                    continue
                name, digest, row, start, count = (np.concatenate(x) for x in zip(*parts))
                by, _, new = first_of_equal(name, digest, order[row], key[row], start)
                late = by[~new]
                if len(late):
                    ranges = as_ranges(order[row[late]], key[row[late]], start[late], start[late] + count[late] - 1)
                    o, k, data = packed_by_document(*ranges)
                    yield found_rows((mix((o ^ k).view(U)) >> U(1)).astype(np.int64), o, k, RANGES, data)
                # a segment that a batch holds twice is known to be repeated: its first goes on twice over
                twice = np.append(~new[1:], False)[new] if len(new) else new
                keep = np.concatenate([by[new], by[new][twice]])
                bin_ = of_bin(name[keep], bins)
                by = np.argsort(bin_, kind="stable")
                keep, bin_ = keep[by], bin_[by]
                first = np.flatnonzero(row_groups(bin_))
                data = [Blob.pack(name[k], digest[k], row[k], start[k], count[k], order, key) for k in np.split(keep, first[1:])]
                yield found_rows(bin_[first], 0, 0, SEGMENTS, pa.array(data, pa.binary()))

    def judge(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        name, digest, order, key, start, count = (np.concatenate(x) for x in zip(*map(Blob.unpack, blobs)))
        by = np.lexsort((start, key, order, digest, name))
        in_bucket = row_groups(name[by])
        lone = in_bucket & np.append(in_bucket[1:], True)
        by = by[~lone]  # met once in the whole corpus
        if not len(by):
            return
        new = row_groups(name[by], digest[by])
        place = new | row_groups(order[by], key[by], start[by])
        late = by[~new & place]
        if len(late):
            o, k, data = packed_by_document(*as_ranges(order[late], key[late], start[late], start[late] + count[late] - 1))
            yield found_rows(0, o, k, RANGES, data)
        first = by[new]
        o, k, data = packed_by_document(order[first], key[first], start[first], count[first], name[first].view(np.int64))
        yield found_rows(0, o, k, WANTED, data)

    dealt = deal(rows.mapInArrow(cut_batches, FOUND))
    return cut(dealt.mapInArrow(lambda batches: bin_by_bin(batches, judge), FOUND))


def deal(found: DataFrame) -> DataFrame:
    """Rows of one bin together, in the order of bins; ranges are dealt out by document."""
    n = default_partitions(found.sparkSession)
    return found.repartition(n, "kind", "bin").sortWithinPartitions("kind", "bin")


def bin_by_bin(batches, judge) -> Iterator[pa.RecordBatch]:
    """Hands each bin's rows over as a whole; other rows pass through."""
    held: list[bytes] = []
    held_bin = None
    for batch in batches:
        kind, bin_ = batch.column("kind").to_numpy(), batch.column("bin").to_numpy()
        n = int((kind == SEGMENTS).sum())  # they come first
        if n < batch.num_rows:
            yield batch.slice(n)
        edge = np.flatnonzero(np.concatenate([row_groups(bin_[:n]), [True]])).tolist() if n else []
        for a, b in zip(edge[:-1], edge[1:]):
            if held_bin != bin_[a] and held:
                yield from judge(held)
                held = []
            held_bin = bin_[a]
            held += batch.column("data").slice(a, b - a).to_pylist()
    if held:
        yield from judge(held)


def sorted_ranges(wanted: DataFrame, length: int, bins: int) -> DataFrame:
    """Ranges of repeated strings that suffix sorting finds in the wanted segments; rows hold text and wanted."""

    def fetch(batches):
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            begins = np.concatenate([[0], ends[:-1]])
            order, key = (batch.column(c).to_numpy() for c in ("id_order", "id_hash"))
            lists = batch.column("wanted")
            per_row = [b"".join(x) for x in lists.to_pylist()]
            flat = np.frombuffer(b"".join(per_row), np.int64).reshape(-1, 3)
            row = np.repeat(np.arange(len(per_row)), [len(x) // 24 for x in per_row])
            start, count, name = flat[:, 0], flat[:, 1], flat[:, 2].view(U)
            # repeated rows hold the same segments, which count once
            once = np.sort(np.unique(np.stack([order[row], key[row], start], axis=1), axis=0, return_index=True)[1])
            row, start, count, name = row[once], start[once], count[once], name[once]
            bin_ = of_bin(name, bins)
            by = np.argsort(bin_, kind="stable")
            row, start, count, name, bin_ = row[by], start[by], count[by], name[by], bin_[by]
            first = np.flatnonzero(row_groups(bin_)) if len(bin_) else np.zeros(0, np.int64)
            blobs = []
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(bin_)]):
                size = count[a:b] + length - 1
                begin = begins[row[a:b]] + start[a:b]
                at = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
                parts = (np.array([b - a]), name[a:b], order[row[a:b]], key[row[a:b]], start[a:b], count[a:b])
                blobs.append(b"".join(p.tobytes() for p in parts) + data[at].tobytes())
            yield found_rows(bin_[first], 0, 0, SEGMENTS, pa.array(blobs, pa.binary()))

    def judge(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts, texts = [], []
        for blob in blobs:
            (n,) = np.frombuffer(blob, np.int64, 1).tolist()
            numbers = np.frombuffer(blob, np.int64, 5 * n, 8).reshape(5, n)
            parts.append(numbers)
            texts.append(np.frombuffer(blob, np.uint8, -1, 8 + 40 * n))
        name, order, key, start, count = np.concatenate(parts, axis=1)
        flat = np.concatenate(texts)
        size = count + length - 1
        begin = np.cumsum(size) - size
        by = np.lexsort((start, key, order, name))
        once = row_groups(name[by], order[by], key[by], start[by])
        by = by[once]
        # whole buckets, up to SORT_BYTES at once
        edge = np.append(np.flatnonzero(row_groups(name[by])), len(by))
        upto = np.concatenate([[0], np.cumsum(size[by])])[edge]
        low = 0
        while low < len(edge) - 1:
            high = max(low + 1, int(np.searchsorted(upto, upto[low] + SORT_BYTES, "right")) - 1)
            use = by[edge[low] : edge[high]]
            low = high
            at = np.arange(int(size[use].sum())) + np.repeat(begin[use] - (np.cumsum(size[use]) - size[use]), size[use])
            late = later_strings(flat[at], size[use], order[use], key[use], start[use], length)
            if len(late[0]):
                o, k, data = packed_by_document(*late)
                yield found_rows(0, o, k, RANGES, data)

    dealt = deal(wanted.mapInArrow(fetch, FOUND))
    return dealt.mapInArrow(lambda batches: bin_by_bin(batches, judge), FOUND)


def later_strings(flat, size, order, key, start, length: int) -> tuple[np.ndarray, ...]:
    """Ranges of string starts that have an equal string earlier, among segments at the given places."""
    segments = Segments(flat, size)
    suffixes = suffix_array(segments, length)
    suffixes = suffixes[segments.left[suffixes] >= length]
    new = np.ones(len(suffixes), bool)
    new[1:] = common_prefixes(segments, suffixes, length) < length
    rank = np.empty(len(size), np.int64)  # places of segments in the order of the corpus
    rank[np.lexsort((start, key, order))] = np.arange(len(size))
    segment = np.searchsorted(segments.begin, suffixes, "right") - 1
    place = rank[segment]
    first = np.flatnonzero(new)
    earliest = np.minimum.reduceat(place, first) if len(first) else place
    late = place != np.repeat(earliest, np.diff(np.append(first, len(suffixes))))
    segment, at = segment[late], (start[segment] + suffixes - segments.begin[segment])[late]
    return as_ranges(order[segment], key[segment], at, at)


SPANS = "array<struct<start: long, end: long>>"


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT
) -> DataFrame:
    """One row per input row: the id (as doc_id), n_bytes, spans (removed, end exclusive) and kept (binary)."""
    rows = documents_of(docs, id_col, text_col)
    hot_names, n_bytes = hot_anchors(rows, length, hot)
    bins = max(MIN_BINS, default_partitions(docs.sparkSession), -(-n_bytes // BIN_BYTES))
    cutter = Shared(docs.sparkSession, Cutter(length, np.sort(hot_names)))
    found = repeated_segments(rows.drop("doc_id"), length, cutter, bins)
    by = ["id_order", "id_hash"]
    wanted = found.where(F.col("kind") == WANTED).groupBy(*by).agg(F.collect_list("data").alias("wanted"))
    texts = rows.join(wanted, by)  # with all columns, as below, so that the texts are dealt out once
    ranges = found.where(F.col("kind") == RANGES).unionByName(sorted_ranges(texts, length, SORT_BINS * bins))
    marks = ranges.groupBy(*by).agg(F.collect_list("data").alias("marks"))
    joined = rows.join(marks, by, "left")

    def remove(batches):
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            begins = np.concatenate([[0], ends[:-1]])
            per_row = [b"".join(x or ()) for x in batch.column("marks").to_pylist()]
            flat = np.frombuffer(b"".join(per_row), np.int64).reshape(-1, 2)
            row = np.repeat(np.arange(len(per_row)), [len(x) // 16 for x in per_row])
            step = np.zeros(len(data) + 1, np.int32)
            np.add.at(step, begins[row] + flat[:, 0], 1)
            np.add.at(step, begins[row] + flat[:, 1] + length, -1)
            gone = np.cumsum(step[:-1]) > 0
            edge = np.zeros(len(data) + 1, bool)
            edge[1:-1] = gone[1:] != gone[:-1]
            edge[begins[begins < len(data)]] = True
            at = np.flatnonzero(edge[:-1])
            until = np.append(at[1:], len(data))
            at, until = at[gone[at]], until[gone[at]]
            doc = np.searchsorted(ends, at, "right")
            spans = pa.ListArray.from_arrays(
                np.searchsorted(doc, np.arange(len(ends) + 1)).astype(np.int32),
                pa.StructArray.from_arrays([pa.array(at - begins[doc]), pa.array(until - begins[doc])], names=["start", "end"]),
            )
            left = np.concatenate([[0], np.cumsum(~gone)])
            kept = data[~gone].tobytes()
            cuts = left[np.append(begins[:1], ends)] if len(ends) else left[:1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ends - begins),
                    spans,
                    pa.array([kept[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary()),
                ],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return joined.mapInArrow(remove, f"doc_id long, n_bytes long, spans {SPANS}, kept binary")


def digest(cleaned: DataFrame) -> DataFrame:
    """Counts and the hash of the kept bytes, from the removed spans."""
    length = F.transform("spans", lambda s: s["end"] - s["start"])
    return cleaned.select(
        "doc_id",
        "n_bytes",
        F.aggregate(length, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
