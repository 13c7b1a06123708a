"""Arithmetic on small grids held as flat arrays (row-major), as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)


def mean(x: Column) -> Column:
    return F.try_divide(total(x), F.size(x))


def normalise(x: Column, flat: float = 1e-6) -> Column:
    """To 0..1 by least and greatest; a flat grid is all 0."""
    scaled = lambda r: F.transform(x, lambda v: F.when(r["high"] - r["low"] < flat, 0.0).otherwise((v - r["low"]) / (r["high"] - r["low"])))
    return let(F.struct(F.array_min(x).alias("low"), F.array_max(x).alias("high")), scaled)


def rows(x: Column, width: int) -> Column:
    return F.transform(F.sequence(F.lit(0), (F.size(x) / width).cast("int") - 1), lambda i: F.slice(x, i * width + 1, width))


def row_variance(x: Column, width: int) -> Column:
    """Population variance of the rows' means: high where lines of text alternate with gaps."""
    return let(F.transform(rows(x, width), lambda r: total(r) / width), variance)


def variance(x: Column) -> Column:
    return let(mean(x), lambda mid: mean(F.transform(x, lambda v: (v - mid) * (v - mid))))


def standardised(x: Column) -> Column:
    scaled = lambda s: F.transform(x, lambda v: (v - s["mid"]) / (s["deviation"] + 1e-6))
    return let(F.struct(mean(x).alias("mid"), F.sqrt(variance(x)).alias("deviation")), scaled)


def rotated(x: Column, width: int, k: int) -> Column:
    """A square grid after k counter-clockwise quarter turns."""
    n = width
    at = {0: lambda r, c: (r, c), 1: lambda r, c: (c, n - 1 - r), 2: lambda r, c: (n - 1 - r, n - 1 - c), 3: lambda r, c: (n - 1 - c, r)}[k % 4]
    spots = [r * n + c for r, c in (at(r, c) for r in range(n) for c in range(n))]
    return F.transform(F.array(*map(F.lit, spots)), lambda i: F.get(x, i))


def correlation(a: Column, b: Column) -> Column:
    return mean(F.zip_with(standardised(a), standardised(b), lambda p, q: p * q))


def best_rotation(a: Column, b: Column, width: int) -> Column:
    """struct<k, score>: the turn of ``b`` that agrees best with ``a``, the first of equals."""
    # a turned grid is standardised as the grid is
    dot = lambda p, q: mean(F.zip_with(p, q, lambda v, w: v * w))
    scores = lambda z: F.array(*[dot(z["a"], rotated(z["b"], width, k)) for k in range(4)])
    best = lambda s: F.struct((F.array_position(s, F.array_max(s)) - 1).cast("int").alias("k"), F.array_max(s).alias("score"))
    return let(let(F.struct(standardised(a).alias("a"), standardised(b).alias("b")), scores), best)


def share(x: Column, holds) -> Column:
    """The share of a grid's cells for which a condition holds."""
    return F.size(F.filter(x, holds)) / F.size(x)


def edge_share(x: Column, width: int, ink: int) -> Column:
    """struct<top, bottom, left, right>: the share of cells darker than ``ink`` along each side."""
    rows = F.size(x) / width

    def side(inside, cells: Column) -> Column:
        on = F.transform(x, lambda v, i: (v < ink) & inside(F.floor(i / width), i % width))
        return F.size(F.filter(on, lambda v: v)) / cells

    whole = F.lit(width)
    return F.struct(side(lambda r, c: r == 0, whole).alias("top"), side(lambda r, c: r == rows - 1, whole).alias("bottom"), side(lambda r, c: c == 0, rows).alias("left"), side(lambda r, c: c == width - 1, rows).alias("right"))


def iou(a: Column, b: Column) -> Column:
    """(intersection + 1) / (union + 1) of two 0/1 grids."""
    return (total(F.zip_with(a, b, lambda p, q: p * q)) + 1) / (total(F.zip_with(a, b, lambda p, q: F.greatest(p, q))) + 1)


def histogram(x: Column, bins: int) -> Column:
    """Counts of the whole numbers 0..bins-1."""
    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.size(F.filter(x, lambda v: v == i)))


def otsu(x: Column, bins: int = 256) -> Column:
    """The threshold t (of whole numbers below ``bins``) with the greatest variance between v <= t and v > t, the least of equals.

    One fold over the sorted values; the variance is compared as a ratio of whole numbers' products in double."""
    n, s = F.size(x).cast("double"), total(F.transform(x, lambda v: v.cast("double")))

    def score(t: Column) -> Column:
        low = F.filter(x, lambda v: v <= t)
        w, m = F.size(low).cast("double"), total(F.transform(low, lambda v: v.cast("double")))
        gap = m * n - s * w
        return F.when((w > 0) & (w < n), gap * gap / (w * (n - w))).otherwise(F.lit(0.0))

    levels = F.array_sort(F.array_distinct(x))
    scores = F.transform(levels, score)
    return F.element_at(levels, F.array_position(scores, F.array_max(scores)).cast("int"))


def seam_costs(x: Column, width: int, penalty: float) -> Column:
    """The last row of the cumulative costs of top-to-bottom seams that move at most one column a row."""
    grid = rows(x, width)
    side = lambda prev, i: F.when((i >= 0) & (i < width), F.get(prev, i) + penalty).otherwise(F.lit(float("inf")))
    step = lambda prev, row: F.transform(row, lambda v, i: v + F.least(side(prev, i - 1), F.get(prev, i), side(prev, i + 1)))
    return F.aggregate(F.slice(grid, 2, width), grid[0], step)
