"""Approximate nearest neighbours by collision-counting hashing.

Every block hashes its vectors (at unit length) by random projections, one at a time, and keeps each
projection as a sorted array of (value, vector). A query opens a window around its own value in
every array and counts how often each vector lies in one; virtual rehashing widens all windows, round
by round, and only the newly covered stretches are counted. Vectors that collide in at least
``THRESHOLD`` of the arrays are verified by their true cosine; a query stops when enough of them have
been seen or its windows cover the arrays.

The share that must be verified depends on the data: of independent normal vectors (64 components, nearest
cosines near 0.45) a quarter has to pass for nine of ten true neighbours among it, whatever the windows.

Null, empty and zero vectors and those with null or non-finite components take no part; ties go to
the smaller vec_id; with fewer than k candidates all are returned; an empty table has an empty result. The projections come from a fixed
seed and need no sample; every row is indexed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.blocks import search

PROJECTIONS = 48
#: Share of the arrays in which a vector must collide with the query.
THRESHOLD = 0.6
#: First half-width of the windows (in standard deviations of a projection) and its growth per round.
FIRST, GROWTH = 0.9, 1.3
#: A query stops when so many vectors passed: so many times k, or this share of a block if that is more.
TIMES, SHARE = 45, 0.25


def _even(x: np.ndarray) -> np.ndarray:
    """The vectors times powers of two, so that no square leaves the range of doubles; cosines stay exactly the same."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def collide(q: np.ndarray, v: np.ndarray, v_ids: np.ndarray, q_ids: np.ndarray, k: int):
    n, d = v.shape
    rng = np.random.default_rng([2026, d])
    axes = rng.standard_normal((d, PROJECTIONS))
    v, q = _even(v), _even(q)
    size_v, size_q = np.sqrt((v * v).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
    unit = v / size_v[:, None]
    values, asked = unit @ axes, (q / size_q[:, None]) @ axes
    order = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T)
    lines = np.take_along_axis(values.T, order, axis=1)
    flat = order.ravel()
    base = (np.arange(PROJECTIONS) * n)[:, None]
    spread = values.std(axis=0) + 1e-12
    enough, need = max(TIMES * k, int(SHARE * n)), int(np.ceil(THRESHOLD * PROJECTIONS))
    lo = np.stack([np.searchsorted(lines[j], asked[:, j]) for j in range(PROJECTIONS)], axis=1)
    hi = lo.copy()
    seen = np.zeros((len(q), n), np.uint8)
    active = np.arange(len(q))
    width = FIRST
    while len(active):
        new_lo, new_hi = lo[active], hi[active]
        for j in range(PROJECTIONS):
            new_lo[:, j] = np.searchsorted(lines[j], asked[active, j] - width * spread[j], "left")
            new_hi[:, j] = np.searchsorted(lines[j], asked[active, j] + width * spread[j], "right")
        new_lo, new_hi = np.minimum(new_lo, lo[active]), np.maximum(new_hi, hi[active])
        on = []
        for r, i in enumerate(active):
            cuts = np.stack([new_lo[r], lo[i], hi[i], new_hi[r]], axis=1) + base
            new = [flat[x:y] for a, b, c, e in cuts.tolist() for x, y in ((a, b), (c, e))]
            seen[i] += np.bincount(np.concatenate(new), minlength=n).astype(np.uint8)
            on.append(np.count_nonzero(seen[i] >= need) <= enough and (new_hi[r] - new_lo[r]).min() < n)
        lo[active], hi[active] = new_lo, new_hi
        active = active[np.array(on, bool)]
        width *= GROWTH
    at, scores = [], []
    for i in range(len(q)):
        own = np.flatnonzero((seen[i] >= need) & (v_ids != q_ids[i]))
        if len(own) > k:
            near = unit[own] @ q[i]
            own = own[near >= np.partition(near, len(own) - k)[len(own) - k] - 1e-9 * size_q[i]]
        cosine = (v[own] * q[i]).sum(axis=1) / (size_v[own] * size_q[i])
        first = np.lexsort((v_ids[own], -cosine))[:k]
        at.append(own[first])
        scores.append(cosine[first])
    return at, scores


def nearest(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score (cosine, double)."""
    return search(vectors, is_query, k, lambda q, v, v_ids, q_ids: collide(q, v, v_ids, q_ids, k), "double", nonzero=True)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, 5)
