"""SimHash near-duplicates over a byte-position inverted index.

Fingerprints: 64 bits; bit ``b`` is set if more than half of the document's
word shingles (repeats included) have it set in their XXH64.

Search: two fingerprints within ``max_bits`` differing bits differ in at most
``max_bits`` bytes, so of 8 byte positions at least ``8 - max_bits`` agree.  The
index posts each distinct fingerprint under the values of its byte positions,
four at a time in two halves: whichever 5 positions agree, 3 of them lie in one
half, so each half posts its 4 triples of positions.  Within a posting list the
shared positional bytes of a pair are tallied; pairs with fewer than
``8 - max_bits`` are dropped, the rest verified by their Hamming distance.

Lists longer than ``list_size`` are cut into blocks that meet pairwise, so no
task holds an unbounded list.  A block reports the links of a spanning forest,
not all its pairs: that loses no connection.  Groups are the connected
components over distinct fingerprints, found by alternating minimum-neighbour
steps with reliable checkpoints.

Null text counts as empty; a document without words has fingerprint zero and is
linked like any other.  Rows with a null id keep their fingerprint and get the
component of their equals (null if none has an id).  Repeated rows stay.  An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekko.llm.common import cut_lineage, keyed, map_texts, slices

# Bit counts of a byte value, one row for each value (rule: numpy's bit order, low bit first).
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, words: int = 3, piece: int = 200_000) -> int:
    """Unsigned fingerprint of one text; long texts are hashed ``piece`` shingles at a time."""
    from xxhash import xxh64_intdigest as xxh

    # bytes.lower() lowers A-Z only, bytes.split() cuts at \x20 and \x09-\x0D
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    width = min(words, len(tokens))
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(tokens) - width + 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, piece):
        until = min(n, at + piece)
        hashes = np.array([xxh(line[a:b], 42) for a, b in zip(
            starts[at:until].tolist(), ends[at + width - 1:until + width - 1].tolist(), strict=True)], dtype="<u8")
        columns = hashes.view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            ones[8 * byte:8 * byte + 8] += np.bincount(columns[:, byte], minlength=256) @ BYTE_BITS
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``fp`` (the 64 bits as a signed long)."""
    def make(texts: list[str]) -> list[pa.Array]:
        values = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
        return [pa.array(values.view(np.int64))]

    return map_texts(docs, id_col, text_col, [T.StructField("fp", T.LongType())], make)


def byte_at(fp, position: int):
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(0xFF)


def postings(fps: DataFrame, max_bits: int) -> DataFrame:
    """(``list``, ``fp``) rows: one for each index entry of a distinct fingerprint.

    A list is named by its positions (above) and their byte values (below).
    """
    low, high = range(4), range(4, 8)
    shared = 8 - max_bits
    take = -(-shared // 2)      # of `shared` agreeing positions, so many lie in one half
    groups = [g for half in (low, high) for g in combinations(half, take)]
    entries = []
    for number, group in enumerate(groups):
        value = F.lit(number).cast("long")
        for position in group:
            value = F.shiftleft(value, 8).bitwiseOR(byte_at(F.col("fp"), position))
        entries.append(value)
    return fps.select(F.explode(F.array(*entries)).alias("list"), "fp")


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links (root, fp) that connect what pairs within ``max_bits`` connect, one root a group.

    Pairs are tallied a row block at a time: shared positional bytes first, then
    the Hamming distance of those with at least ``8 - max_bits``.
    """
    n = len(fps)
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    values = fps.view(np.uint64)
    columns = np.ascontiguousarray(values.view(np.uint8).reshape(n, 8).T)
    step = max(1, min(n, 2_000_000 // max(n, 1)))
    for at in range(0, n, step):
        tally = np.zeros((min(step, n - at), n), dtype=np.uint8)
        for column in columns:
            tally += column[at:at + step, None] == column[None, :]
        a, b = np.nonzero(tally >= 8 - max_bits)
        a += at
        a, b = a[a < b], b[a < b]
        near = np.bitwise_count(values[a] ^ values[b]) <= max_bits
        for i, j in zip(a[near].tolist(), b[near].tolist(), strict=True):
            i, j = find(i), find(j)
            if i != j:
                parent[max(i, j)] = min(i, j)
    return [(int(fps[r]), int(fps[i])) for i in range(n) if (r := find(i)) != i]


def links(fps: DataFrame, max_bits: int = 3, list_size: int = 2048) -> DataFrame:
    """Links (``u``, ``v``) between distinct fingerprints, enough to connect every group."""
    posted = postings(fps.select("fp").distinct(), max_bits)
    sizes = posted.groupBy("list").agg(F.count("*").alias("n")).filter("n > 1")
    kept = posted.join(sizes, "list")
    block_size = list_size // 2
    blocks = F.ceil(F.col("n") / block_size).cast("int")
    # a list of up to list_size is one block that meets itself; a longer one is dealt to
    # ceil(n / block_size) blocks, and each member goes to the meetings of its block
    mine = F.when(F.col("n") <= list_size, F.lit(0)).otherwise(F.pmod(F.xxhash64("fp"), blocks).cast("int"))
    others = F.when(F.col("n") <= list_size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks - 1))
    met = (kept.select("list", "fp", mine.alias("b"), F.explode(others).alias("o"))
           .select("list", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "fp")
           .groupBy("list", "i", "j").agg(F.collect_list("fp").alias("fps")).select("fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            values, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            sizes = np.diff(offsets)
            u, v = small_links(values, offsets[:-1], sizes, max_bits)
            for i in np.nonzero(sizes > SMALL)[0]:
                for a, b in forest(np.sort(values[offsets[i]:offsets[i + 1]]), max_bits):
                    u.append(a)
                    v.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return met.mapInArrow(run, "u long, v long").distinct()


SMALL = 8


def small_links(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                max_bits: int) -> tuple[list[int], list[int]]:
    """All links of lists of up to ``SMALL`` members, tallied for all lists together."""
    u, v = [], []
    bits = values.view(np.uint64)
    for size in range(2, SMALL + 1):
        rows = starts[sizes == size]
        for i, j in combinations(range(size), 2):
            a, b = bits[rows + i], bits[rows + j]
            tally = (a.view(np.uint8) == b.view(np.uint8)).reshape(-1, 8).sum(axis=1)
            keep = tally >= 8 - max_bits
            a, b = a[keep], b[keep]
            near = np.bitwise_count(a ^ b) <= max_bits
            u += a[near].view(np.int64).tolist()
            v += b[near].view(np.int64).tolist()
    return u, v


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(``fp``, ``root``) for every fingerprint with a link; the root is one member of its group.

    Each round links every neighbour that is larger than a node to the smallest
    one around it, then every smaller neighbour likewise, until nothing changes.
    Both steps aggregate before they shuffle and join on splittable keys.
    """
    edges = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .filter("u != v").distinct())
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u != v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").filter("u != v").distinct())
        edges = cut_lineage(small)
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if row == state:
            break
        state = row
    else:
        raise RuntimeError(f"groups did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))


def grouped(marked: DataFrame, least, max_bits: int, list_size: int) -> DataFrame:
    """(``fp``, ``least``): for each distinct fingerprint the minimum of ``least`` over its group."""
    own = marked.groupBy("fp").agg(F.min(least).alias("own"))
    roots = components(links(marked, max_bits, list_size))
    classes = own.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = classes.groupBy("root").agg(F.min("own").alias("least"))
    return classes.join(groups, "root").select("fp", "least")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3, list_size: int = 2048,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``fp`` and ``component_id``, the smallest id that links reach."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be between 0 and 7")
    marked = cut_lineage(fingerprints(docs, words, id_col, text_col))
    named = grouped(marked, F.col(id_col), max_bits, list_size).withColumnRenamed("least", "component_id")
    return marked.join(named, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 3, list_size: int = 2048,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all columns, of which each group keeps the one with the smallest id
    (a null id comes last; of rows that repeat an id the one with the smallest hash of its text,
    once)."""
    rows = keyed(docs, id_col, text_col)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 4_000_000):
                values = np.array([fingerprint(t, words) for t in part.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(values.view(np.int64))],
                                                 names=["k", "t", "fp"])

    marked = cut_lineage(rows.select("k", "text", "t").mapInArrow(make, "k long, t long, fp long"))
    kept = (grouped(marked, F.struct("k", "t"), max_bits, list_size).select("least.k", "least.t").distinct())
    first = Window.partitionBy("k", "t").orderBy("k")       # the join's own order: no shuffle of its own
    return (rows.join(kept, ["k", "t"]).withColumn("n", F.row_number().over(first)).filter("n = 1")
            .select(*(F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                      for c in docs.columns)))


def hex_fingerprints(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
