"""Suffix-array dedup: remove every byte covered by a string of ``length`` bytes that
also starts in a document with a smaller id.

A full suffix array of a corpus does not fit any shuffle, so the array is sparse.
Of every window of ``length`` bytes the smallest hash among its 20-byte grams
picks an anchor; equal windows pick the same one, so only suffixes at anchors
(one in about 17 bytes) need comparing.

1. Windows that share an anchor form a segment.  Segments meet by anchor; one
   that equals a segment of a smaller id is covered as a whole.
2. Anchors whose segments differ between documents are undecided.  The text
   before and after each goes to the anchor's bucket, where the suffixes that
   begin at the anchors, and the reversed prefixes that end there, are put in
   order by deep-shallow sorting.  Common prefixes of neighbours in the two
   orders tell for every window which others equal it; the smallest id stays.

Segments are judged within each batch before the shuffle, so a passage that is
everywhere reaches its bucket once a batch; the spans this covers travel under keys of
their own.  An anchor that many different segments share
(found by a first pass; their number is bounded) is replaced by its windows, each
an anchor of its own, so no bucket collects one anchor's documents.

Null text counts as empty.  A null id comes after all others.  Strings within one
document, and in rows that repeat its id, never remove anything.  Rows that
repeat an id are kept apart by a hash of their text.  An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekko.llm.common import keyed, slices, stored
from rekko.llm.suffix_sort import common_prefixes, deep_shallow

GRAM = 20                       # bytes of an anchor
BLOCK = 1 << 19                 # bytes hashed at once
PLACE = 24                      # bits of a position within a block
HOT_SHARE = 1 / 20_000          # of all segments; an anchor with more is replaced by its windows
HOT_LEAST = 1000
BUCKET_SEGMENTS, BUCKET_TEXTS = 200_000, 20_000
SLICE = 8_000_000               # bytes of text a task works on at a time
COVERED_SPANS = 50_000          # spans in one row of those covered within a batch

ODD = np.uint64(0x9E3779B97F4A7C15)
MORE = np.uint64(0xD6E8FEB86659FD93)
U32 = np.uint64(32)
KEY = np.uint64(2 ** 40 - 1)    # bits of an anchor's hash that travel with a segment


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U32)) * MORE
    x = (x ^ (x >> U32)) * MORE
    return x ^ (x >> U32)


def words_at_all(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one little-endian number (zeros behind the end)."""
    w = np.zeros(len(data) + 8, dtype=np.uint64)
    w[:len(data)] = data
    for shift in (1, 2, 4):
        w[:-shift] |= w[shift:] << np.uint64(8 * shift)
    return w[:len(data)]


def hash_strings(words: np.ndarray, start: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``size`` bytes from each start."""
    h = mix(seed * ODD + size.astype(np.uint64))
    last = len(words) - 1
    for at in range(0, int(size.max(initial=0)), 8):
        left = np.clip(size - at, 0, 8)
        word = words[np.minimum(start + at, last)] & (np.uint64(2 ** 64 - 1) >> (8 * (8 - np.maximum(left, 1))).astype(
            np.uint64))
        h = np.where(left > 0, mix(h * ODD + word), h)
    return h


class Segments:
    """Columns of segments: anchor hash, segment hash, document number, start, windows, anchor's offset."""

    names = ("key", "seg", "doc", "start", "count", "offset")
    kinds = (np.uint64, np.uint64, np.uint32, np.uint32, np.uint8, np.uint8)

    def __init__(self, columns: list[np.ndarray]):
        for name, kind, c in zip(self.names, self.kinds, columns, strict=True):
            setattr(self, name, c.astype(kind, copy=False))

    def columns(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.names]

    def take(self, index) -> Segments:
        return Segments([c[index] for c in self.columns()])

    @classmethod
    def join(cls, parts: list[Segments]) -> Segments:
        if not parts:
            return cls([np.zeros(0, k) for k in cls.kinds])
        return cls([np.concatenate(c) for c in zip(*(p.columns() for p in parts), strict=True)])


def block_segments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, base: np.ndarray,
                   length: int, hot: np.ndarray | None) -> Segments:
    """Segments of one block: documents ``doc`` lie at [starts, ends) in ``data``; ``base``
    is the position of a document's first byte here in its whole text."""
    n = len(data)
    words = words_at_all(np.concatenate((data, np.zeros(length + 16, np.uint8))))
    gram = mix((words[:n] * ODD + words[8:n + 8]) * MORE + words[GRAM - 8:n + GRAM - 8])
    least = gram & ~np.uint64(2 ** PLACE - 1) | np.arange(n, dtype=np.uint64)
    least = np.concatenate((least, np.full(length, 2 ** 64 - 1, dtype=np.uint64)))
    width, reach = length - GRAM + 1, 1
    while 2 * reach <= width:
        least[:-reach] = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if width > reach:
        least[:reach - width] = np.minimum(least[:reach - width], least[width - reach:])
    anchor = (least[:n] & np.uint64(2 ** PLACE - 1)).astype(np.int64)
    edges = np.zeros(n + 1, dtype=np.int8)
    whole = ends - starts >= length
    starts, ends, doc, base = starts[whole], ends[whole], doc[whole], base[whole]
    edges[starts] += 1
    np.subtract.at(edges, ends - length + 1, 1)
    valid = np.cumsum(edges[:n], dtype=np.int8) > 0
    new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    new[starts] = True
    start = np.nonzero(valid & new)[0]
    if not len(start):
        return Segments.join([])
    own = np.searchsorted(starts, start, side="right") - 1
    until = np.minimum(np.append(start[1:], n), ends[own] - length + 1)
    count, anchor = until - start, anchor[start]
    key = gram[anchor]
    if hot is not None and len(hot):
        spread = np.isin(key, hot)
        if spread.any():
            more = count[spread]
            at = np.repeat(start[spread], more) + np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
            ones = np.ones(len(at), dtype=np.int64)
            windows = hash_strings(words, at, ones * length, np.full(len(at), 7, np.uint64))
            start, own, count = (np.concatenate((x[~spread], y)) for x, y in (
                (start, at), (own, np.repeat(own[spread], more)), (count, ones)))
            anchor = np.concatenate((anchor[~spread], at))
            key = np.concatenate((key[~spread], windows))
    seg = hash_strings(words, start, count + length - 1, (anchor - start).astype(np.uint64))
    return Segments([key, seg, doc[own], base[own] + start - starts[own], count, anchor - start])


def segments(texts: list[bytes], length: int, hot: np.ndarray | None) -> Segments:
    """Segments of texts, a block of about ``BLOCK`` bytes at a time; a longer text is cut so
    that every window lies in one block."""
    parts: list[Segments] = []
    held: list[tuple[bytes, int, int]] = []

    def flush() -> None:
        sizes = np.array([len(b) for b, _, _ in held], dtype=np.int64)
        ends = np.cumsum(sizes)
        parts.append(block_segments(
            np.frombuffer(b"".join(b for b, _, _ in held), dtype=np.uint8), ends - sizes, ends,
            np.array([d for _, d, _ in held]), np.array([p for _, _, p in held]), length, hot))
        held.clear()

    total = 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), BLOCK):
            piece = text[at:at + BLOCK + length - 1]
            if held and total + len(piece) > BLOCK:
                flush()
                total = 0
            held.append((piece, i, at))
            total += len(piece)
    if held:
        flush()
    return Segments.join(parts)


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of one length as compressed bytes; wide numbers by byte, so equal parts lie together."""
    import zstandard

    raw = b"".join(narrow(c, 8).T.tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes, kinds: list[tuple[type, int]]) -> list[np.ndarray]:
    """Columns of ``pack``; for each its type and the bytes that were kept of it."""
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    n = len(raw) // sum(w for _, w in kinds)
    out, at = [], 0
    for kind, width in kinds:
        full = np.zeros((n, np.dtype(kind).itemsize), dtype=np.uint8)
        full[:, :width] = raw[at:at + n * width].reshape(width, n).T
        out.append(full.view(kind).reshape(n))
        at += n * width
    return out


def narrow(column: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of each value (all of a narrower one), a row each."""
    if column.ndim == 2:
        return column
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), column.itemsize)[:, :width]


def sorted_batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Keys, tags and UTF-8 texts of a batch by (key, tag); rows that repeat both come once."""
    k, tag = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "tag"))
    order = np.lexsort((tag, k))
    same = np.concatenate(([False], (k[order][1:] == k[order][:-1]) & (tag[order][1:] == tag[order][:-1])))
    order = order[~same] if len(order) else order
    texts = batch.column("text").cast(pa.binary())
    return k[order], tag[order], [texts[int(i)].as_py() for i in order]


def within_batch(found: Segments, k: np.ndarray) -> tuple[Segments, Segments]:
    """Segments to be judged elsewhere, and those that equal one of a smaller id in the batch."""
    if not len(found.key):
        return found, found
    both = found.key ^ mix(found.seg)
    order = np.argsort(both, kind="stable")     # documents come by key, so each group does too
    ids, both = k[found.doc[order]], both[order]
    first = np.concatenate(([True], both[1:] != both[:-1]))
    least = ids[first][np.cumsum(first) - 1]
    covered = np.zeros(len(order), dtype=bool)
    covered[order] = ids > least
    return found.take(~covered), found.take(covered)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about ``SLICE`` bytes of text; what Arrow keeps of the one before goes back first."""
    for batch in batches:
        names = batch.schema.names
        for part in slices(batch.select(["k", "text", *(c for c in names if c not in ("k", "text"))]), SLICE):
            yield part
            pa.default_memory_pool().release_unused()


def hot_anchors(rows: DataFrame, length: int) -> tuple[np.ndarray, int]:
    """Anchors with a large share of all segments, and the number of segments.

    A batch reports the anchors with a quarter of that share of its own, and the
    sums are cut at half the share, so at most 4 / HOT_SHARE anchors come back.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            k, _, texts = sorted_batch(batch)
            found, _ = within_batch(segments(texts, length, None), k)
            keys, counts = np.unique(found.key, return_counts=True)
            many = counts >= max(2, HOT_SHARE / 4 * len(found.key))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(keys[many].view(np.int64), 0)),
                 pa.array(np.append(counts[many], 0).astype(np.int64)),
                 pa.array(np.append(np.zeros(many.sum(), np.int64), len(found.key)))], names=["key", "n", "total"])

    counts = stored(rows.select("k", "tag", "text").mapInArrow(run, "key long, n long, total long"), "anchors")
    total = counts.agg(F.sum("total")).first()[0] or 0
    least = max(HOT_LEAST, HOT_SHARE / 2 * total) / 2
    hot = counts.filter("n > 0").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return np.array([r["key"] for r in hot.collect()], dtype=np.int64).view(np.uint64), total


# What travels of a segment: five bytes of the anchor's hash (its bucket holds the rest), the
# segment's hash, the document's place in the list beside it, start, windows, offset.
PACKED = [(np.uint64, 5), (np.uint64, 8), (np.uint32, 3), (np.uint32, 4), (np.uint8, 1), (np.uint8, 1)]
DOCS = [(np.int64, 8), (np.int64, 4)]
COVERED = [(np.uint32, 3), (np.uint32, 4), (np.uint8, 1)]


def deal(rows: DataFrame, length: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """(``bucket``, ``docs``, ``segments``, ``covered``): packed segments of a batch for each bucket;
    and rows of up to ``COVERED_SPANS`` spans covered within the batch, under negative keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            k, tag, texts = sorted_batch(batch)
            found, done = within_batch(segments(texts, length, hot), k)
            home = (mix(found.key ^ ODD) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(home, kind="stable")
            present = np.unique(home)
            cuts = [np.searchsorted(home[order], present, side).tolist() for side in ("left", "right")]
            out = []
            for b, c, d in zip(present.tolist(), *cuts, strict=True):
                mine = found.take(order[c:d])
                used, place = np.unique(mine.doc, return_inverse=True)
                out.append((b, pack([k[used], narrow(tag[used], 4)]),
                            pack([narrow(mine.key & KEY, 5), mine.seg, narrow(place.astype(np.uint32), 3),
                                  mine.start, mine.count, mine.offset]), None))
            for c in range(0, len(done.key), COVERED_SPANS):
                late = done.take(slice(c, c + COVERED_SPANS))
                used, place = np.unique(late.doc, return_inverse=True)
                # they need no judging: a key of their own spreads them
                at = used[:1]
                own = mix(mix(late.seg[:1] + tag[at].view(np.uint64)) + k[at].view(np.uint64) + np.uint64(c))
                out.append((-1 - int(own[0] >> np.uint64(33)), pack([k[used], narrow(tag[used], 4)]), None,
                            pack([narrow(place.astype(np.uint32), 3), late.start, late.count])))
            for at in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out[at:at + 64], strict=True), (
                        pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                    names=["bucket", "docs", "segments", "covered"])

    return rows.select("k", "tag", "text").mapInArrow(
        run, "bucket int, docs binary, segments binary, covered binary")


def judge(dealt: DataFrame, length: int) -> DataFrame:
    """Spans that are covered (``key`` null) and segments still undecided (with their anchor)."""
    schema = "k long, tag long, start int, count int, offset int, key long"

    def spans_and_left(columns: list[np.ndarray], key: np.ndarray, n: int) -> pa.Table:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        return pa.table([*(pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, kinds, strict=True)),
                         pa.array(key, mask=np.arange(len(key)) < n)],
                        names=["k", "tag", "start", "count", "offset", "key"])

    def run(table: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = []
        covered: list[list[np.ndarray]] = []
        for docs, packed, late in zip(*(table.column(c).to_pylist() for c in ("docs", "segments", "covered")),
                                      strict=True):
            k, tag = unpack(docs, DOCS)
            if late is None:
                key, seg, doc, start, count, offset = unpack(packed, PACKED)
                columns.append([key, seg, k[doc], tag[doc], start, count, offset])
            else:
                doc, start, count = unpack(late, COVERED)
                covered.append([k[doc], tag[doc], start, count])
        if not columns:         # spans covered within their batch only
            done = [np.concatenate(c) for c in zip(*covered, strict=True)]
            n = len(done[0])
            return spans_and_left([*done, np.zeros(n, np.uint8)], np.zeros(n, np.int64), n)
        key, seg, k, tag, start, count, offset = (np.concatenate(c) for c in zip(*columns, strict=True))
        del columns, covered
        order = np.lexsort((k, seg, key))
        key, seg, k, tag, start, count, offset = (c[order] for c in (key, seg, k, tag, start, count, offset))
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new_seg = new_key | np.concatenate(([True], seg[1:] != seg[:-1]))
        of_key, of_seg = np.cumsum(new_key) - 1, np.cumsum(new_seg) - 1
        at = np.nonzero(new_key)[0]
        several = (np.add.reduceat(new_seg, at) > 1) & (np.minimum.reduceat(k, at) < np.maximum.reduceat(k, at))
        late = k > k[new_seg][of_seg]
        open_ = several[of_key] & ~late
        n = int(late.sum())
        both = [np.concatenate((x[late], x[open_])) for x in (k, tag, start, count, offset)]
        return spans_and_left(both, np.concatenate((np.zeros(n, np.int64), key[open_].view(np.int64))), n)

    return dealt.groupBy("bucket").applyInArrow(run, schema)


def undecided_texts(rows: DataFrame, undecided: DataFrame, length: int, buckets: int) -> DataFrame:
    """The text of each undecided segment, in the bucket of its anchor."""
    asked = undecided.groupBy("k", "tag").agg(
        F.collect_list(F.struct("start", "count", "offset", "key")).alias("asked"))
    schema = "bucket int, key long, k long, tag long, start int, count int, offset int, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            lists = batch.column("asked")
            flat = lists.flatten()
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            start, count = (flat.field(c).to_numpy() for c in ("start", "count"))
            key = flat.field("key").to_numpy()
            home = (mix(key.view(np.uint64) + MORE) % np.uint64(buckets)).astype(np.int32)
            for at in range(0, len(owner), 50_000):
                cut = slice(at, at + 50_000)
                data = [texts[o][s:s + c + length - 1] for o, s, c in zip(
                    owner[cut].tolist(), start[cut].tolist(), count[cut].tolist(), strict=True)]
                which = pa.array(owner[cut])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(home[cut]), pa.array(key[cut]), batch.column("k").take(which),
                     batch.column("tag").take(which), pa.array(start[cut]), pa.array(count[cut]),
                     flat.field("offset").slice(at, len(data)), pa.array(data, pa.binary())],
                    names=["bucket", "key", "k", "tag", "start", "count", "offset", "bytes"])

    # all columns of `rows` stay, so that the last join finds this one's shuffle of the texts again
    return rows.join(asked, ["k", "tag"]).select("k", "tag", "text", "row", "asked").mapInArrow(run, schema)


def equal_windows(k: np.ndarray, key: np.ndarray, count: np.ndarray, offset: np.ndarray, texts: list[bytes],
                  length: int) -> np.ndarray:
    """For each segment and each window (by its offset before the anchor), whether an equal
    window has a smaller id: rows x (length - GRAM + 1) booleans."""
    n, reach = len(k), length - GRAM + 1
    groups = np.unique(key, return_inverse=True)[1]
    after, before = np.zeros((n, length + -length % 8), np.uint8), np.zeros((n, reach + -reach % 8), np.uint8)
    for i, (text, o) in enumerate(zip(texts, offset.tolist(), strict=True)):
        right = np.frombuffer(text, np.uint8)
        after[i, :min(length, len(text) - o)] = right[o:o + length]
        before[i, :o] = right[:o][::-1]
    right_size = np.minimum(length, count.astype(np.int64) + length - 1 - offset)
    left_size = offset.astype(np.int64)
    right = deep_shallow(after, groups, 24, right_size)
    left = deep_shallow(before, groups, 8, left_size)
    right_common = common_prefixes(after, right_size, groups, right)
    left_common = common_prefixes(before, left_size, groups, left)
    out = np.zeros((n, reach), dtype=bool)
    ends, starts = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for o in range(reach):
        there = np.nonzero((offset >= o) & (offset - o < count))[0]
        if len(there) < 2:
            continue
        ends[right] = np.cumsum(right_common < length - o)
        starts[left] = np.cumsum(left_common < o)
        same = ends[there] * (n + 1) + starts[there]
        order = np.lexsort((k[there], same))
        same, ids = same[order], k[there][order]
        first = np.concatenate(([True], same[1:] != same[:-1]))
        out[there[order], o] = ids > ids[first][np.cumsum(first) - 1]
    return out


def decide(texts: DataFrame, length: int) -> DataFrame:
    """(``k``, ``tag``, ``start``, ``count``): runs of covered windows of the undecided segments."""
    def run(table: pa.Table) -> pa.Table:
        k, tag, key, start, count, offset = (table.column(c).to_numpy() for c in (
            "k", "tag", "key", "start", "count", "offset"))
        late = equal_windows(k, key, count, offset, table.column("bytes").to_pylist(), length)
        # by position: the window furthest before the anchor comes first
        flags = np.zeros((len(k), late.shape[1] + 2), dtype=np.int8)
        flags[:, 1:-1] = late[:, ::-1]
        step = np.diff(flags, axis=1)
        row, begin = np.nonzero(step == 1)
        _, end = np.nonzero(step == -1)
        at = start[row] + offset[row] - (late.shape[1] - 1 - begin)
        return pa.table([pa.array(k[row]), pa.array(tag[row]), pa.array(at.astype(np.int32)),
                         pa.array((end - begin).astype(np.int32))], names=["k", "tag", "start", "count"])

    return texts.groupBy("bucket").applyInArrow(run, "k long, tag long, start int, count int")


def cut_out(text: bytes, starts: np.ndarray, counts: np.ndarray, length: int) -> tuple[bytes, int, int]:
    """The bytes no span covers; removed bytes and maximal removed runs."""
    if not len(starts):
        return text, 0, 0
    order = np.argsort(starts, kind="stable")
    begin = starts[order].astype(np.int64)
    end = np.maximum.accumulate(begin + counts[order] + length - 1)
    first = np.concatenate(([True], begin[1:] > end[:-1]))
    begin, end = begin[first], end[np.append(np.nonzero(first)[0][1:] - 1, len(end) - 1)]
    kept, at = [], 0
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), int((end - begin).sum()), len(begin)


def tag_of(t: Column) -> Column:
    return t.bitwiseAND(F.lit(0x7FFFFFFF))


def dedup_bytes(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
                whole_rows: bool = False) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary).

    With ``whole_rows`` the documents come back with all their columns and what is
    left as their text; characters that a cut went through are dropped.
    """
    if not 40 <= length <= 200:
        raise ValueError("length must lie between 40 and 200 bytes")
    rows = keyed(docs, id_col, text_col).select("k", tag_of(F.col("t")).alias("tag"), "text", "row")
    hot, total = hot_anchors(rows, length)
    judged = stored(judge(deal(rows, length, hot, max(1, -(-total // BUCKET_SEGMENTS))), length), "segments")
    undecided = judged.filter("key IS NOT NULL")
    buckets = max(1, -(-undecided.count() // BUCKET_TEXTS))
    spans = judged.filter("key IS NULL").select("k", "tag", "start", "count").union(
        decide(undecided_texts(rows, undecided, length, buckets), length))
    spans = spans.groupBy("k", "tag").agg(F.collect_list(F.struct("start", "count")).alias("spans"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType),
                           *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept", T.StringType() if whole_rows else T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)
        for whole in batches:
            for batch in slices(whole, 8_000_000):
                lists = batch.column("spans")
                sizes, removed, runs, kept = [], [], [], []
                for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                    own = lists[i].values
                    starts, counts = (empty, empty) if own is None else (
                        own.field(c).to_numpy() for c in ("start", "count"))
                    left, gone, n = cut_out(text, starts, counts, length)
                    sizes.append(len(text))
                    removed.append(gone)
                    runs.append(n)
                    kept.append(left.decode(errors="ignore") if whole_rows else left)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)),
                     pa.array(kept, pa.string() if whole_rows else pa.binary())], names=schema.names)

    out = rows.join(spans, ["k", "tag"], "left").select("row", "text", "spans").mapInArrow(run, schema)
    if whole_rows:
        return out.select(*(F.col("kept").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                            for c in docs.columns))
    return out.select(F.col("row").getField(id_col).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
