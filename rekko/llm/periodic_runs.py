"""Periodic runs: stretches of words that repeat with a period, found and collapsed.

A run is a maximal stretch of consecutive words whose smallest period q (words q apart are
equal) holds at least ``repeats`` times in it, and that is at least ``min_words`` long.

For a period q the positions whose word equals the one q behind form stretches; a run
gives one of at least m = max(min_words, repeats x q) - q positions.  Such a stretch holds
a whole block of a grid with step m // 2, so only grid points are
looked at (a harmonic sum over all periods), first by a few words, then by
longest common extensions (``cover_lce``).  From the first whole block of a
stretch its beginning is bisected with extensions, its end is one extension.  A
period that is a multiple of the run's own gives the same stretch; the least stays.

Words are what stands between blanks (space, tab to carriage return).  Null text is
an empty one and has no words.  Repeated rows get equal results, an empty table gives
no rows, and extra columns are ignored.  A document is worked on whole, a
slice of documents at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekko.llm.common import map_texts
from rekko.llm.cover_lce import CoverLce

RUN = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
RUN_ARROW = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
PAIRS = 1_000_000       # grid points looked at together
FEW = 4                 # words compared before an extension is asked for


def word_lists(texts: list[str]) -> list[list[bytes]]:
    return [t.encode("utf-8", "surrogatepass").split() for t in texts]


class Slice:
    """Documents laid end to end, the longest first, each with a separator of its own behind it."""

    def __init__(self, docs: list[list[bytes]]):
        self.size = np.array([len(d) for d in docs], dtype=np.int64)
        self.by_size = np.argsort(-self.size, kind="stable")
        sizes = self.size[self.by_size]
        self.start = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
        self.end = self.start + sizes
        found = pa.array([w for i in self.by_size for w in docs[i]], pa.binary()).dictionary_encode()
        ids = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        total = int(sizes.sum()) + len(docs)
        self.doc = np.repeat(np.arange(len(docs)), sizes + 1)
        self.words = np.empty(total, dtype=np.int64)
        inside = np.ones(total, dtype=bool)
        inside[self.end] = False
        self.words[inside] = ids
        self.words[self.end] = len(found.dictionary) + np.arange(len(docs))


def grid(sizes: np.ndarray, ends: np.ndarray, min_words: int, repeats: int):
    """Chunks of (period, step, position) over all periods; documents shorter than a run of the period are left out.

    ``sizes`` fall, so the documents long enough for a period are the first ones.
    """
    periods = np.arange(1, int(sizes[0]) // repeats + 1, dtype=np.int64)
    least = np.maximum(min_words, repeats * periods)
    n_docs = np.searchsorted(-sizes, -least, side="right")      # documents with at least that many words
    periods, least, n_docs = (x[n_docs > 0] for x in (periods, least, n_docs))
    step = np.maximum(1, (least - periods) // 2)
    counts = -(-ends[n_docs - 1] // step)
    before = np.concatenate(([0], np.cumsum(counts)))
    total = int(before[-1])
    for low in range(0, total, PAIRS):
        k = np.arange(low, min(low + PAIRS, total))
        which = np.searchsorted(before, k, side="right") - 1
        yield periods[which], step[which], (k - before[which]) * step[which]


def find_runs(docs: list[list[bytes]], min_words: int = 24, repeats: int = 3) -> list[list[tuple[int, int, int]]]:
    """For each document its runs (start, length, period) by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    if not docs or max(len(d) for d in docs) < max(min_words, repeats):
        return out
    s = Slice(docs)
    lce = None
    found = []
    padded = np.concatenate((s.words, -1 - np.arange(FEW)))
    n = len(s.words)
    for period, step, x in grid(s.size[s.by_size], s.end, min_words, repeats):
        ok = np.flatnonzero(x + period < n)
        ok = ok[padded[x[ok]] == padded[x[ok] + period[ok]]]
        for ahead in range(1, FEW):
            near = ahead < step[ok]
            a = np.minimum(x[ok] + ahead, n)
            b = np.minimum(x[ok] + ahead + period[ok], n + 1)
            ok = ok[~near | (padded[a] == padded[b])]
        x, period, step = x[ok], period[ok], step[ok]
        ok = np.flatnonzero(x + period < s.end[s.doc[x]])
        if len(ok):
            lce = lce or CoverLce(s.words, s.doc)
            x, period, step = x[ok], period[ok], step[ok]
            far = lce.extend(x, x + period)
            whole = far >= step
            found.append(np.stack((period[whole], x[whole], step[whole], far[whole])))
    if not found:
        return out
    period, x, step, far = np.concatenate(found, axis=1)
    # the first whole block of each stretch (blocks of a period come in order)
    first = np.ones(len(x), dtype=bool)
    first[1:] = (period[1:] != period[:-1]) | (x[1:] != x[:-1] + step[:-1])
    period, x, step, far = (v[first] for v in (period, x, step, far))
    doc = s.doc[x]
    low, high = np.maximum(x - step + 1, s.start[doc]), x.copy()
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        reaches = lce.extend(middle, middle + period[open_]) >= x[open_] - middle
        high[open_[reaches]] = middle[reaches]
        low[open_[~reaches]] = middle[~reaches] + 1
    length = x + period + far - low
    long_enough = length >= np.maximum(min_words, repeats * period)
    least: dict[tuple[int, int, int], int] = {}
    for d, a, size, q in zip(*(v[long_enough].tolist() for v in (doc, low, length, period)), strict=True):
        key = (d, a, size)
        least[key] = min(least.get(key, q), q)
    for (d, a, size), q in least.items():
        out[s.by_size[d]].append((a - int(s.start[d]), size, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, each run cut to its first period, joined by a space; a word goes if any run drops it."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    stays = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in stays.tolist()])


def collapse_runs(docs: DataFrame, min_words: int = 24, repeats: int = 3,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``runs`` (start, length, period in words) and ``collapsed``, the text without
    the repetitions."""
    def make(texts: list[str]) -> list[pa.Array]:
        words = word_lists(texts)
        runs = find_runs(words, min_words, repeats)
        kept = pa.array([collapse(w, r) for w, r in zip(words, runs, strict=True)], pa.binary())
        as_rows = [[dict(start=a, length=n, period=q) for a, n, q in r] for r in runs]
        return [pa.array(as_rows, RUN_ARROW), kept.cast(pa.string())]

    fields = [T.StructField("runs", RUN), T.StructField("collapsed", T.StringType())]
    return map_texts(docs, id_col, text_col, fields, make, 2_000_000)


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the run with the greatest exact number of repetitions, and digests."""
    def ahead(a: Column, b: Column) -> Column:
        more, less = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(more > less, -1).when(more < less, 1).when(a["start"] < b["start"], -1)
                .when(a["start"] > b["start"], 1).when(a["period"] < b["period"], -1)
                .when(a["period"] > b["period"], 1).otherwise(0))

    best = F.get(F.array_sort("runs", ahead), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return found.select(id_col, "runs", "collapsed", best.alias("best")).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A tenth of the documents with periodic words planted, as the contract of the query defines it:
    h = crc32 of the id, g = h div 10; if h % 10 = 0 each word from a = g % n on becomes one of the p
    words behind a, p = 1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(F.col(id_col).cast("string"))
    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    # the words are cut out of the planted documents only
    planted = docs.withColumn("_w", F.when(h % 10 == 0, words)).withColumn("_g", F.floor(h / 10)).withColumn(
        "_a", F.expr("CASE WHEN size(_w) > 0 THEN int(_g % size(_w)) END")).withColumn(
        "_p", F.expr("int(1 + (size(_w) - _a) div (3 + _g % 8))"))
    text = F.expr("array_join(transform(_w, (w, i) -> CASE WHEN i >= _a THEN _w[_a + (i - _a) % _p] ELSE w END), ' ')")
    return planted.withColumn(text_col, F.when(F.col("_p").isNotNull(), text).otherwise(F.col(text_col))).select(
        id_col, text_col)
