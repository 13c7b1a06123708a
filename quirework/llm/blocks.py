"""Blocks of queries against blocks of vectors: what the two vector searches have in common.

The rows are dealt by a hash of vec_id to blocks of about ``BLOCK`` vectors, the stated queries to
blocks of about ``QUERIES``; each pair of a query block and a vector block is one bounded group, and
the best of all groups are merged per query. A query never meets vectors of another length than its
own; of the usable vectors of a repeated vec_id the shortest counts, of those the least in the order of
their components. All rows of an id meet in a partial aggregate first, so one that very many rows repeat
stays small.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm._common import settled

BLOCK, QUERIES = 8192, 4096

#: (query vectors, vectors, vector ids, k) -> for each query, positions and scores of its best vectors
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[list[np.ndarray], list[np.ndarray]]]


def usable(column: Column, nonzero: bool) -> Column:
    """Neither null nor empty nor holding null or non-finite components; with ``nonzero`` not all zero either."""
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = column.isNotNull() & (F.size(column) > 0) & ~odd
    return ok & F.exists(column, lambda x: x != 0) if nonzero else ok


def search(vectors: DataFrame, is_query: Column, k: int, best: Search, score: str, nonzero: bool) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all vectors for each query, ties to the smaller vec_id."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"), nonzero))
    least = F.min(F.struct(F.size("v").alias("size"), "v")).alias("least")
    rows = settled(rows.groupBy("vec_id").agg(least).select("vec_id", F.col("least.v").alias("v")))
    total, asked = rows.agg(F.count("*"), F.count_if(is_query)).first()
    g, h = max(1, -(-total // BLOCK)), max(1, -(-asked // QUERIES))
    spread = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = rows.select(spread(g, 1).alias("g"), each(h).alias("h"), F.lit(0).alias("q"), "vec_id", "v")
    asks = rows.where(is_query).select(each(g).alias("g"), spread(h, 2).alias("h"), F.lit(1).alias("q"), "vec_id", "v")

    def group(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("vec_id").to_numpy()
        asked = table.column("q").to_numpy() == 1
        lists = table.column("v").combine_chunks()
        lengths = lists.value_lengths().to_numpy()
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for d in np.unique(lengths[asked]):
            part = []
            for mask in (asked & (lengths == d), ~asked & (lengths == d)):
                order = np.argsort(ids[mask])
                part.append((ids[mask][order], flat[starts[mask][order][:, None] + np.arange(d)]))
            (q_ids, q), (v_ids, v) = part
            if not len(v_ids):
                continue
            at, scores = best(q, v, v_ids, q_ids)
            out += [(np.full(len(a), i), v_ids[a], s) for i, a, s in zip(q_ids, at, scores, strict=True)]
        cat = lambda i, kind: np.concatenate([x[i] for x in out]).astype(kind) if out else np.zeros(0, kind)
        return pa.table({"query_id": cat(0, np.int64), "vec_id": cat(1, np.int64), "score": cat(2, np.float64 if score == "double" else np.int64)})

    found = held.unionByName(asks).groupBy("g", "h").applyInArrow(group, f"query_id long, vec_id long, score {score}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(order).cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
