"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors become sparse rows of integer weights floor(scale * x); a term is a component with a weight
other than 0. In each block the postings of one term after another, weighted by the queries' own
weights, are scattered into dense score arrays (one row per query); the k best of each row are
partitioned out, and those of all blocks merged.

Vectors that are null, empty or hold null or non-finite components take no part; ties go to the
smaller vec_id; with fewer than k candidates all are returned; an empty table has an empty result. Finite
components of any size are exact: where 64 bits could overflow, whole numbers without a bound are used, and a
score beyond 64 bits counts as the nearest number of 64 bits.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.blocks import search

#: Queries whose score arrays are filled together: they stay in the processor's cache.
TOGETHER = 16


def quantised(x: np.ndarray, scale: float) -> np.ndarray:
    """Integer weights; Python's own whole numbers where some are 2**40 or more."""
    w = np.floor(x * scale)
    if len(w) and np.abs(w).max() >= 2.0**40:
        return np.array([[int(c) if np.isfinite(c) else math.floor(Fraction(float(o)) * Fraction(scale)) for c, o in zip(r, own, strict=True)] for r, own in zip(w, x, strict=True)], object)
    return w.astype(np.int64)


def accumulate(queries: np.ndarray, weights: np.ndarray, k: int, q_ids: np.ndarray, v_ids: np.ndarray):
    """For each query the positions and scores of its k best rows of ``weights``, not of its own id."""
    n, terms = weights.shape
    reach = int(np.abs(queries).max(initial=0)) * int(np.abs(weights).max(initial=0)) * terms
    kind = np.int32 if reach < 2**31 else np.int64 if reach < 2**63 else object
    postings = []
    for t in range(terms):
        ids = np.flatnonzero(weights[:, t] != 0)
        # a list with most rows in it is kept with its gaps, so that scattering runs straight on
        postings.append((None, np.ascontiguousarray(weights[:, t], kind)) if len(ids) > n // 4 else (ids, weights[ids, t].astype(kind)))
    at, scores = [], []
    for lo in range(0, len(queries), TOGETHER):
        part = queries[lo : lo + TOGETHER].astype(kind)
        acc = np.zeros((len(part), n), kind)
        room = np.empty(n, kind)
        for t, (ids, own) in enumerate(postings):
            for i in np.flatnonzero(part[:, t] != 0):
                if ids is None:
                    np.multiply(own, part[i, t], out=room)
                    acc[i] += room
                else:
                    acc[i, ids] += own * part[i, t]
        for i, row in enumerate(acc):
            row = row.astype(np.int64) if kind is not object else np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in row], np.int64)
            p = np.searchsorted(v_ids, q_ids[lo + i])
            other = np.arange(n) if p >= n or v_ids[p] != q_ids[lo + i] else np.delete(np.arange(n), p)
            own = row[other]
            if len(other) > k:
                # all that reach the k-th score, so that ties are cut by id alone
                least = np.partition(own, len(own) - k)[len(own) - k]
                keep = own >= least
                other, own = other[keep], own[keep]
            first = np.lexsort((v_ids[other], ~own))[:k]
            at.append(other[first])
            scores.append(own[first])
    return at, scores


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: float) -> DataFrame:
    """query_id, rank, vec_id, score (long) by the inner product of floor(scale * x)."""

    def best(q, v, v_ids, q_ids):
        return accumulate(quantised(q, scale), quantised(v, scale), k, q_ids, v_ids)

    return search(vectors, is_query, k, best, "long", nonzero=False)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, 20, 64.0)


OP9_SQL = """
WITH v AS (SELECT vec_id::BIGINT AS vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0),
u AS (SELECT vec_id, e FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
w AS (SELECT vec_id, list_transform((min([len(e)::DOUBLE] || e))[2:], lambda x: floor(64 * x)) AS w FROM u GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM w q JOIN w c ON c.vec_id != q.vec_id AND len(c.w) = len(q.w) WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
