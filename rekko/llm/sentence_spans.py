"""Substring dedup over sliding runs of sentences.

A text is cut into sentences.  At every sentence begins a run: ``span`` consecutive
sentences, and more until it holds ``min_words`` words; its sentences (without the blanks
behind them) are hashed to 128 bits.  Over the whole table,
the first place of a run is the one with the smallest document id and position;
every sentence that lies in a run at a later place is removed, whichever other
runs it lies in.  Near the end of a text, where the words no longer suffice, no
run begins.  A text with fewer sentences than ``span`` has one run, all of it, if it has the words.

A task keeps one row for each run of a batch of documents, its first place there.
The later ones are repeats whatever the other tasks hold and travel apart from it,
so a run that is everywhere reaches its shuffle key once a batch.

Null text counts as empty and has no sentences.  A null id comes after all
others.  Rows that repeat id and text are one document, and each gets that
document's result; rows that repeat an id with another text are ordered by a
hash of the text.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekko.llm.common import keyed, slices

# A sentence with the marks and blanks behind it (the same pattern is in the SQL statement).
SENTENCE = re.compile(r"[^.!?\n]*[.!?\n][.!?\n \t]*|[^.!?\n]+")
BLANK = " \t\n"
LATER = 256     # places in one row of known repeats


def sentences(text: str) -> tuple[list[str], list[int]]:
    """Pieces that join to the text, and the places of those that hold more than blanks."""
    pieces = SENTENCE.findall(text)
    return pieces, [i for i, p in enumerate(pieces) if p.strip(BLANK)]


def word_count(sentence: str) -> int:
    """Words of a sentence without blanks at its ends."""
    plain = sentence.replace("\t", " ").replace("\n", " ")
    return sum(map(bool, plain.split(" "))) if "  " in plain else plain.count(" ") + 1


def runs(clean: list[str], span: int, min_words: int) -> list[tuple[int, int]]:
    """First sentence, and the one behind the last, of each run, in order."""
    words = [word_count(c) for c in clean]
    out: list[tuple[int, int]] = []
    end = held = 0
    for start in range(len(clean)):
        while end < len(clean) and (held < min_words or end - start < span):
            held += words[end]
            end += 1
        if held >= min_words and (end - start >= span or start == 0):
            out.append((start, end))
        held -= words[start]
    return out


def hashed_runs(text: str, span: int, min_words: int) -> list[tuple[int, bytes]]:
    """First sentence and 128-bit hash of each run, in order."""
    from xxhash import xxh3_128_digest

    pieces, full = sentences(text)
    clean = [pieces[i].strip(BLANK) for i in full]
    return [(a, xxh3_128_digest("\n".join(clean[a:b]))) for a, b in runs(clean, span, min_words)]


def places(docs: DataFrame, span: int, min_words: int) -> DataFrame:
    """One row for each run of a batch: hash (``h``, ``g``) and first place (``k``, ``t``, ``pos``);
    and rows of up to ``LATER`` further places, three little-endian longs each in one binary."""
    schema = "h long, g long, k long, t long, pos long, later binary"
    names = ["h", "g", "k", "t", "pos", "later"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.select(["k", "text", "t"]), 32_000_000):
                keys = sorted(zip(part.column(0).to_pylist(), part.column(2).to_pylist(),
                                  range(part.num_rows), strict=True))
                first: dict[bytes, tuple[int, int, int]] = {}
                later: dict[bytes, list[tuple[int, int, int]]] = {}
                before = None
                for k, t, i in keys:
                    if (k, t) == before:
                        continue
                    before = (k, t)
                    for pos, h in hashed_runs(part.column(1)[i].as_py(), span, min_words):
                        if h in first:
                            later.setdefault(h, []).append((k, t, pos))
                        else:
                            first[h] = (k, t, pos)
                if not first:
                    continue
                hashes = np.frombuffer(b"".join(first), dtype="<i8").reshape(-1, 2)
                place = np.array(list(first.values()), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (*hashes.T, *place.T)] + [pa.nulls(len(first), pa.binary())], names=names)
                rest = np.array([x for found in later.values() for x in found], dtype="<i8").reshape(-1, 3)
                parts = [rest[at:at + LATER] for at in range(0, len(rest), LATER)]
                if parts:
                    # known repeats need no judging: a key of their own spreads them
                    none = [pa.nulls(len(parts), pa.int64())] * 3
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(x[0, 0]) for x in parts]), pa.array([-1 - int(x[0, 2]) for x in parts]), *none,
                         pa.array([x.tobytes() for x in parts], pa.binary())], names=names)

    return docs.select("k", "t", "text").mapInArrow(run, schema)


def repeats(found: DataFrame) -> DataFrame:
    """(``k``, ``t``, ``starts``): for each document the runs that have an earlier place."""
    w = Window.partitionBy("h", "g")
    place = F.struct("k", "t", "pos")
    judged = found.select("later", place.alias("place"), F.min(place).over(w).alias("first")).filter(
        (F.col("place") > F.col("first")) | F.col("later").isNotNull())
    late = judged.select(F.when(F.col("place") > F.col("first"), F.col("place")).alias("place"), "later")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("place").drop_null()
            rest = b"".join(x for x in batch.column("later").to_pylist() if x)
            more = np.frombuffer(rest, dtype="<i8").reshape(-1, 3)
            columns = [np.concatenate((own.field(c).to_numpy(zero_copy_only=False), more[:, i]))
                       for i, c in enumerate(("k", "t", "pos"))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k", "t", "pos"])

    return (late.mapInArrow(run, "k long, t long, pos long")
            .groupBy("k", "t").agg(F.collect_list("pos").alias("starts")))


def remove_spans(text: str, starts: list[int], span: int, min_words: int) -> tuple[str, int, int]:
    """Text without the sentences of the runs at ``starts``; sentences, and removed ones."""
    pieces, full = sentences(text)
    if not starts:
        return text, len(full), 0
    ends = dict(runs([pieces[i].strip(BLANK) for i in full], span, min_words))
    gone = {i for s in starts for i in full[s:ends[s]]}
    return "".join(p for i, p in enumerate(pieces) if i not in gone), len(full), len(gone)


def dedup_sentences(docs: DataFrame, span: int = 2, min_words: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_sentences``, ``n_removed`` and ``kept``, the text that is left."""
    rows = keyed(docs, id_col, text_col)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 8_000_000):
                out = [remove_spans(t, s or [], span, min_words) for t, s in
                       zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x[1] for x in out], pa.int64()),
                     pa.array([x[2] for x in out], pa.int64()), pa.array([x[0] for x in out], pa.string())],
                    names=schema.names)

    return (rows.join(repeats(places(rows, span, min_words)), ["k", "t"], "left")
            .select(F.col("row").getField(id_col).alias(id_col), "text", "starts").mapInArrow(run, schema))
