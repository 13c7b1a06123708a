"""One-dimensional profiles: rows (id, pos, value), one for each position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _along(group: str, pos: str) -> Window:
    return Window.partitionBy(group).orderBy(pos)


def _whole(group: str) -> Window:
    return Window.partitionBy(group)


def prominence(profile: DataFrame, offset: int, group: str = "id", pos: str = "pos", value: str = "value") -> DataFrame:
    """Adds ``prominence``: the lower of the flanks at +-offset (clipped at the ends), less the value."""
    w = _along(group, pos)
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag(value, offset).over(w), F.first(value).over(full))
    after = F.coalesce(F.lead(value, offset).over(w), F.last(value).over(full))
    return profile.withColumn("prominence", F.least(before, after) - F.col(value))


def deepest(profile: DataFrame, group: str = "id", pos: str = "pos", low: float = 0.0, high: float = 1.0) -> DataFrame:
    """The position of the greatest prominence within a band of the profile's length, the first of equals."""
    w = _along(group, pos)
    placed = profile.withColumn("_n", F.row_number().over(w) - 1).withColumn("_all", F.count("*").over(_whole(group)))
    inside = placed.where((F.col("_n") >= F.floor(F.col("_all") * low)) & (F.col("_n") < F.floor(F.col("_all") * high)))
    best = F.max(F.struct(F.col("prominence").alias("p"), (-F.col("_n")).alias("i"), F.col(pos).alias("pos")))
    return inside.groupBy(group).agg(best.alias("b")).select(group, F.col("b.pos").alias(pos), F.col("b.p").alias("prominence"))


def smoothed(profile: DataFrame, weights: list[float], group: str = "id", pos: str = "pos", value: str = "value") -> DataFrame:
    """Adds ``smooth``: a weighted sum over neighbours; beyond an end the profile is mirrored without repeating its last value.

    A profile is one row or column of one image: it is collected under its key."""
    half = len(weights) // 2
    rows = profile.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v")))).alias("_all")).withColumn("_n", F.size("_all"))

    def at(i: Column) -> Column:
        ahead = F.abs(i)  # mirrored at the first value, then at the last
        back = F.when(ahead < F.col("_n"), ahead).otherwise(2 * (F.col("_n") - 1) - ahead)
        return F.get("_all", F.greatest(F.lit(0), back).cast("int"))["v"]

    def mixed(i: Column) -> Column:
        first, *rest = (at(i + k - half) * float(w) for k, w in enumerate(weights))
        return sum(rest, first)

    smooth = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.struct(F.get("_all", i)["p"].alias(pos), F.get("_all", i)["v"].alias(value), mixed(i).alias("smooth")))
    return rows.select(group, F.inline(smooth))


def local_stats(profile: DataFrame, half: int, group: str = "id", pos: str = "pos", value: str = "value") -> DataFrame:
    """Adds ``local_mean``, ``local_std`` and ``dark`` (more than 6 below the mean of its surroundings)."""
    w = _along(group, pos).rowsBetween(-half, half)
    mean = F.avg(value).over(w)
    std = F.sqrt(F.greatest(F.avg(F.col(value) * F.col(value)).over(w) - mean * mean, F.lit(0.0)))
    return profile.withColumn("local_mean", mean).withColumn("local_std", std).withColumn("dark", (mean - F.col(value) > 6).cast("int"))


def priors(profile: DataFrame, group: str = "id", pos: str = "pos", value: str = "smooth") -> DataFrame:
    """``valley``: the least value in the middle fifth of a smoothed profile against its median; a deep one shows an open spread."""
    placed = profile.withColumn("_i", F.row_number().over(_along(group, pos)) - 1).withColumn("_n", F.count("*").over(_whole(group)))
    inside = (F.col("_i") >= F.floor(0.4 * F.col("_n"))) & (F.col("_i") < F.floor(0.6 * F.col("_n")))
    out = placed.groupBy(group).agg(F.median(value).alias("_m"), F.min(F.when(inside, F.col(value))).alias("_low"))
    mid = F.col("_m") + 1e-6
    return out.select(group, (F.coalesce("_low", mid) / mid).alias("valley"))


def spine(profile: DataFrame, group: str = "id", pos: str = "pos", value: str = "smooth", low: float = 0.18, high: float = 0.82, floor: float = 0.05) -> DataFrame:
    """The place of the greatest value in the inner part of each profile (the first of equals) and its ratio to the median, which counts as ``floor`` at least."""
    placed = profile.withColumn("_i", F.row_number().over(_along(group, pos)) - 1).withColumn("_n", F.count("*").over(_whole(group)))
    inside = (F.col("_i") >= F.floor(low * F.col("_n"))) & (F.col("_i") < F.floor(high * F.col("_n")))
    best = F.max(F.when(inside, F.struct(F.col(value).alias("v"), (-F.col("_i")).alias("i")))).alias("_b")
    out = placed.groupBy(group).agg(F.median(value).alias("_m"), best)
    return out.where("_b IS NOT NULL").select(group, (-F.col("_b.i")).cast("long").alias("place"), (F.col("_b.v") / F.greatest("_m", F.lit(floor))).alias("ratio"))


def sauvola(mean: Column, std: Column, k: float = 0.15, reach: float = 128.0) -> Column:
    return mean * (1 + k * (std / reach - 1))


def border_runs(profile: DataFrame, inside: Column, group: str = "id", pos: str = "pos") -> DataFrame:
    """Lengths of the runs at both ends where ``inside`` does not hold."""
    placed = profile.select(group, (F.row_number().over(_along(group, pos)) - 1).alias("n"), inside.alias("ok"))
    found = placed.groupBy(group).agg(F.count("*").alias("length"), F.min(F.when(F.col("ok"), F.col("n"))).alias("first"), F.max(F.when(F.col("ok"), F.col("n"))).alias("last"))
    return found.select(group, "length", F.coalesce("first", "length").alias("leading"), F.coalesce(F.col("length") - 1 - F.col("last"), "length").alias("trailing"))


def off_line(profile: DataFrame, group: str = "id", pos: str = "pos", value: str = "value") -> DataFrame:
    """The greatest distance of a profile from the straight line between its ends."""
    ends = profile.groupBy(group).agg(F.min(pos).alias("p0"), F.max(pos).alias("p1"), F.min_by(value, pos).alias("v0"), F.max_by(value, pos).alias("v1"))
    line = F.col("v0") + (F.col("v1") - F.col("v0")) * F.coalesce(F.try_divide(F.col(pos) - F.col("p0"), F.col("p1") - F.col("p0")), F.lit(0.0))
    return profile.join(ends, group).groupBy(group).agg(F.max(F.abs(F.col(value) - line)).alias("curvature"))


def territories(centres: DataFrame, group: str, centre: str, width: Column) -> DataFrame:
    """Adds ``low`` and ``high``: each centre's territory reaches half-way to its neighbours."""
    w = _along(group, centre)
    mid = lambda other: F.floor((F.col(centre) + other) / 2)
    low = F.coalesce(mid(F.lag(centre).over(w)), F.lit(0))
    return centres.withColumn("low", low.cast("long")).withColumn("high", F.coalesce(mid(F.lead(centre).over(w)), width).cast("long"))


def masked_mean(cells: DataFrame, group: list[str], value: str, mask: Column) -> DataFrame:
    """Mean over the masked cells of a group; null where there are none."""
    return cells.groupBy(*group).agg(F.avg(F.when(mask, F.col(value))).alias("mean"))


def masked_median(cells: DataFrame, group: list[str], value: str, mask: Column, default: float) -> DataFrame:
    return cells.groupBy(*group).agg(F.coalesce(F.median(F.when(mask, F.col(value))), F.lit(default)).alias("median"))
