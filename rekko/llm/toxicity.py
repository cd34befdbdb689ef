"""Toxicity by compression distance: two zstandard dictionaries, one per kind of text.

The ordinary dictionary is trained by zstandard on windows of ordinary
documents.  The toxic dictionary is raw dictionary content: the word beginnings
and words that toxic documents hold far more often than ordinary ones, the most
telling last, where they are cheapest to refer to, followed by the ordinary
content, so that the two differ by the toxic part alone.  A window that is
shorter under the toxic dictionary speaks for toxicity.  A document's score is
the calibrated probability for the gain of its two best windows and the number
of its windows (a long text has more chances), fitted on labelled documents that
the dictionaries have not seen.

Only labelled rows of the training part are learned from, at most
``sample_rows`` of each class of at most ``sample_chars`` characters (a bound on
what the driver holds); scoring reads every window of every text.  Near copies
of a sampled document are left out of the sample, so that one copied text
cannot pass for a pattern.  The ordinary dictionary is trained on every n-th window of
a sampled text, n being its characters over ``train_stride`` (1 at least), so that a long
text does not outweigh the others.

Null text counts as empty, which is one empty window.  Without labels of both
classes every score is the share of toxic labels (0 without any).  A document
labelled twice counts as toxic if any label says so; null labels and labels of
missing documents are ignored.  A null id is not held out (it has no label).
Rows repeat as they come; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekko.llm.common import map_texts

WORD = re.compile(r"[^\W\d_]+")
WINDOW, STEP = 64, 48           # bytes
PREFIXES = range(4, 9)          # lengths of the word beginnings that are tried
ORDINARY_BYTES, TOXIC_MARKS = 4096, 600
LEAST_Z = 6.0                   # standard errors by which a mark's shares must differ


@dataclass(frozen=True)
class Model:
    """Dictionary contents and the calibration; ``weights`` is None where nothing could be learned."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] | None
    share: float


def windows(text: str) -> list[bytes]:
    data = text.lower().encode()
    return [data[i:i + WINDOW] for i in range(0, max(1, len(data) - (WINDOW - STEP)), STEP)]


@functools.lru_cache(maxsize=8)
def compressor(content: bytes):
    """Small windows against raw content: short matches count, no header fields."""
    import zstandard

    params = zstandard.ZstdCompressionParameters(
        window_log=15, chain_log=14, hash_log=14, search_log=3, min_match=4, target_length=16,
        strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=params)


def features(text: str, ordinary: bytes, toxic: bytes) -> tuple[float, float, float]:
    """Gain of the two best windows in bytes, the same squared, and log2 of the windows."""
    plain, marked = compressor(ordinary).compress, compressor(toxic).compress
    first = second = 0
    parts = windows(text)
    for w in parts:
        gain = len(plain(w)) - len(marked(w))
        if gain > second:
            first, second = max(gain, first), min(gain, first)
    return float(first + second), float(first + second) ** 2 / 10, math.log2(len(parts))


def distinct(texts: list[str], shingle: int = 8, most: float = 0.3) -> list[str]:
    """Texts in order, without those that share ``most`` of their word runs with earlier ones."""
    seen: set[int] = set()
    out = []
    for t in texts:
        words = t.split()
        runs = {hash(tuple(words[i:i + shingle])) for i in range(max(1, len(words) - shingle + 1))}
        if len(runs & seen) <= most * len(runs):
            out.append(t)
        seen |= runs
    return out


def marks_of(text: str) -> set[str]:
    words = set(WORD.findall(text))
    return {f" {w} " for w in words} | {" " + w[:k] for w in words for k in PREFIXES if len(w) > k}


def telling(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Marks far more frequent among toxic documents, the most telling first, none inside another."""
    a, b = Counter(), Counter()
    for t in toxic:
        a.update(marks_of(t))
    for t in ordinary:
        b.update(marks_of(t))
    n, m = len(toxic), len(ordinary)

    def z(mark: str) -> float:
        p = (a[mark] + b[mark] + 1) / (n + m + 2)
        return (a[mark] / n - b[mark] / m) / math.sqrt(p * (1 - p) * (1 / n + 1 / m))

    out: list[str] = []
    for score, mark in sorted(((-z(x), x) for x in a)):
        if -score < LEAST_Z or len(out) == TOXIC_MARKS:
            break
        if not any(mark in kept for kept in out):
            out.append(mark)
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a little ridge."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - 1e-3 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(toxic: list[str], ordinary: list[str], share: float, train_stride: int = 256) -> Model:
    """Fit on two lists of distinct texts; ``share`` is the share of toxic labels."""
    import zstandard

    toxic, ordinary = [distinct([t.lower() for t in x]) for x in (toxic, ordinary)]
    cut_a, cut_b = len(toxic) * 2 // 3, len(ordinary) * 2 // 3
    if not cut_a or not cut_b:
        return Model(b"", b"", None, share)
    samples = [w for t in ordinary[:cut_b] for w in windows(t)[::max(1, len(t) // train_stride)]]
    try:
        plain = zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:     # too little text to train on: the text itself
        plain = b"".join(samples)[:ORDINARY_BYTES]
    marked = "".join(reversed(telling(toxic[:cut_a], ordinary[:cut_b]))).encode() + plain
    held = toxic[cut_a:] + ordinary[cut_b:]
    y = np.array([1.0] * (len(toxic) - cut_a) + [0.0] * (len(ordinary) - cut_b))
    x = np.array([features(t, plain, marked) for t in held])
    weight = np.where(y == 1, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum())) * len(y)
    return Model(plain, marked, tuple(logistic(x, y, weight).tolist()), share)


def score(text: str, model: Model) -> float:
    if model.weights is None:
        return model.share
    x = (1.0, *features(text, model.ordinary, model.toxic))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, model.weights, strict=True))))))


def in_training(id_col: Column) -> Column:
    """The part that may be learned from: crc32 of the id's text, modulo 4, is not 2."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 != 2


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 2000, sample_chars: int = 20_000,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_stride: int = 256) -> Model:
    """Learn from a bounded sample of the labelled training documents, chosen by a hash of the id."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
             .filter("id IS NOT NULL AND toxic IN (0, 1)").filter(in_training(F.col("id")))
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if len(counts) < 2:
        return Model(b"", b"", None, share)
    order = F.xxhash64("id")
    picked = None
    for value in (0, 1):    # twice the rows, as some have long or missing texts
        some = known.filter(F.col("toxic") == value).orderBy(order, "id").limit(2 * sample_rows)
        picked = some if picked is None else picked.union(some)
    # at most 4 x sample_rows ids: small enough to broadcast whatever the size of the tables
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .filter(F.length("text").between(1, sample_chars))
            .join(F.broadcast(picked), "id"))
    texts = {}
    for value in (0, 1):
        some = rows.filter(F.col("toxic") == value).orderBy(order, "id", "text").limit(sample_rows)
        texts[value] = [r["text"] for r in some.select("text").collect()]
    return train(texts[1], texts[0], share, train_stride)


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.3,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` (0 to 1) and ``predicted``."""
    def make(texts: list[str]) -> list[pa.Array]:
        return [pa.array([score(t, model) for t in texts], pa.float64())]

    return map_texts(docs, id_col, text_col, [T.StructField("score", T.DoubleType())], make).select(
        id_col, F.coalesce(~in_training(F.col(id_col)), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def score_column(model: Model, text_col: str = "text") -> Column:
    """The score as a column, for callers that keep their rows whole."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: score(t or "", model)).astype("float64")

    return scored(F.coalesce(F.col(text_col), F.lit("")))
