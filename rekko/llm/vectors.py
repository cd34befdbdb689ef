"""Checks and grids shared by the vector searches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vector_col: str, allow_zero: bool) -> DataFrame:
    """(``id``, ``v`` as array of double, ``d`` its length) of the rows with an id and a finite vector.

    Rows that repeat id and vector count once; different vectors under one id all stay.  Vectors of
    different lengths are all kept; a query meets those of its own length.
    """
    out = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    out = out.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    out = out if allow_zero else out.filter(F.exists("v", lambda x: x != 0.0))
    return out.distinct().withColumn("d", F.size("v"))


def grid(vectors: DataFrame, is_query: Column, block_rows: int, query_rows: int) -> DataFrame:
    """Deal candidates and queries to blocks that meet once each.

    A row of the result belongs to a meeting (``c``, ``q``) of one candidate
    block and one query block, and there to the vectors of its length (``d``);
    ``side`` is 0 for a candidate, 1 for a query.
    Blocks are cut by a hash of the row, so no block depends on the data's order;
    the two counts that set their number are the only figures the driver reads.
    """
    n, m = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-m // query_rows))
    block = F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("id", "v", F.lit(1)), F.lit(query_blocks)).cast("int")
    candidates = vectors.select(
        F.lit(0).alias("side"), block.alias("c"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"), "d", "id", "v")
    queries = vectors.filter(is_query).select(
        F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("c"),
        query_block.alias("q"), "d", "id", "v")
    return candidates.union(queries)


def meet(dealt: DataFrame, search: Callable, score_type: str) -> DataFrame:
    """Run ``search(ids, vectors, query_ids, queries)`` on the vectors of each length in every meeting.

    It yields (query_id, ids, scores) for each query.
    """
    score_arrow = pa.int64() if score_type == "long" else pa.float64()

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids = table.column("id").to_numpy()
        lists = table.column("v").combine_chunks()
        flat = lists.flatten().to_numpy().reshape(len(lists), -1)
        order = np.argsort(ids, kind="stable")
        cand, query = order[side[order] == 0], order[side[order] == 1]
        out_q, out_id, out_s = [], [], []
        if len(cand) and len(query):
            for q, found, scores in search(ids[cand], flat[cand], ids[query], flat[query]):
                out_q.append(np.full(len(found), q))
                out_id.append(found)
                out_s.append(scores)
        def joined(parts, kind):
            return pa.array(np.concatenate(parts) if parts else np.zeros(0), kind)
        return pa.table([joined([x.astype(np.int64) for x in out_q], pa.int64()),
                         joined([x.astype(np.int64) for x in out_id], pa.int64()),
                         joined(out_s, score_arrow)], names=["query_id", "vec_id", "score"])

    return dealt.groupBy("c", "q", "d").applyInArrow(run, f"query_id long, vec_id long, score {score_type}")


def own_rows(ids: np.ndarray, query_ids: np.ndarray) -> list[slice]:
    """For each query the places of its own id in the sorted ``ids``."""
    sides = [np.searchsorted(ids, query_ids, side).tolist() for side in ("left", "right")]
    return [slice(a, b) for a, b in zip(*sides, strict=True)]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all blocks for each query: largest score, then smaller id."""
    from pyspark.sql import Window

    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
