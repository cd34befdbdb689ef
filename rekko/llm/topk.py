"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are taken as integers, floor(256 x).  Each candidate block keeps its
ids sorted by value in every dimension.  A query reads the lists in parallel,
from the large end where its own component is positive and from the small end
where it is negative; each id it meets gets its full score at once.  The sum of
the query's components times the values last read bounds every id not met yet:
once it is below the k-th score the search stops.

Vectors that are null or hold null or non-finite components take no part, nor
do rows without an id; zero vectors do.  Vectors of several lengths are searched
apart: a query meets the candidates of its own length.  Rows that repeat id and vector count once.  Different vectors under
one id are all candidates, but not of their own id's queries, which are ranked
together.  Ties go to the smaller id.  Scores beyond the range of a long are held at its ends.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rekko.llm.vectors import grid, meet, own_rows, ranked, usable

LONG = 2 ** 63 - 1


def whole_numbers(vectors: np.ndarray, factor: float = 256.0) -> np.ndarray:
    """floor(factor * x): doubles where every inner product is exact in them, Python integers otherwise."""
    with np.errstate(over="ignore"):
        out = np.floor(vectors * factor)
    top = np.abs(out).max(initial=0.0)
    if top * top * max(1, vectors.shape[1]) < 2.0 ** 53:
        return out
    # the product with a power of two only changes the exponent, so it is exact unless it overflows
    return np.array([[int(x * int(factor) if np.isinf(y) else y) if not np.isinf(y) else int(x) * int(factor)
                      for x, y in zip(row, made, strict=True)] for row, made in zip(vectors, out, strict=True)],
                    dtype=object)


class SortedLists:
    """Ids of a block sorted by each dimension's value, smallest first."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.order = np.ascontiguousarray(np.argsort(values.astype(np.float64), axis=0, kind="stable").T)

    def search(self, query: np.ndarray, own: int | slice, k: int, first: int) -> tuple[np.ndarray, np.ndarray]:
        n, d = self.values.shape
        met = np.zeros(n, dtype=bool)
        met[own] = True
        ids, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=self.values.dtype)
        up, down = np.nonzero(query > 0)[0], np.nonzero(query < 0)[0]
        depth, step = 0, first
        while depth < n:
            until = min(n, depth + step)
            new = np.zeros(n, dtype=bool)
            new[self.order[up, n - until:n - depth]] = True
            new[self.order[down, depth:until]] = True
            if not len(up) and not len(down):       # every score is 0
                new[:] = True
                until = n
            new &= ~met
            met |= new
            found = np.nonzero(new)[0]
            ids = np.concatenate((ids, found))
            scores = np.concatenate((scores, self.values[found] @ query))
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            bound = (self.values[self.order[up, n - until], up] @ query[up]
                     + self.values[self.order[down, until - 1], down] @ query[down])
            if len(ids) == k and bound < scores[-1]:
                break
            depth, step = until, step * 2
        return ids, scores


def top_k(vectors: DataFrame, k: int = 5, query_every: int = 50, first_depth: int = 32,
          block_rows: int = 8192, query_rows: int = 4096,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest integer inner products of each query.

    Queries are the rows whose id is divisible by ``query_every``; the lists are
    read ``first_depth`` deep, then each time twice as far again.
    """
    rows = usable(vectors, id_col, vector_col, allow_zero=True)

    def search(ids, block, query_ids, queries) -> Iterator[tuple]:
        both = whole_numbers(np.concatenate((block, queries)))
        lists, wanted = SortedLists(both[:len(block)]), both[len(block):]
        for q, vector, own in zip(query_ids, wanted, own_rows(ids, query_ids), strict=True):
            found, scores = lists.search(vector, own, k, first_depth)
            yield q, ids[found], np.clip(scores, -LONG, LONG).astype(np.int64)

    dealt = grid(rows, F.col("id") % query_every == 0, block_rows, query_rows)
    return ranked(meet(dealt, search, "long"), k)
