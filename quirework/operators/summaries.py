"""Summaries of runs, volumes and evaluations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_counters(images: DataFrame, *group: str) -> DataFrame:
    """Images, folios, crops under review and failed images (an error and no folio) from (error, folios) rows."""
    flagged = F.size(F.filter("folios", lambda f: f["needs_review"]))
    out = images.groupBy(*group) if group else images
    return out.agg(F.count("*").alias("images"), F.sum(F.size("folios")).alias("folios"), F.sum(flagged).alias("review"), F.count_if(F.col("error").isNotNull() & (F.size("folios") == 0)).alias("errors"))


def review_report(crops: DataFrame, volume: str, crop: Column, blank: Column, reasons: Column, unknown: Column | None = None) -> DataFrame:
    """Per volume: totals, the blank and the flagged crops in order, and how many go on (all but the blank)."""
    flagged = F.size(reasons) > 0
    rows = crops.select(F.col(volume), crop.alias("_c"), blank.alias("_b"), reasons.alias("_r"), flagged.alias("_f"), (unknown if unknown is not None else F.lit(False)).alias("_u"))
    return rows.groupBy(volume).agg(
        F.count("*").alias("total"),
        F.count_if("_b").alias("blank"),
        F.count_if("_f").alias("flagged"),
        F.count_if("_u").alias("status_unknown"),
        F.count_if(~F.col("_b")).alias("submitted"),
        F.sort_array(F.collect_list(F.when(F.col("_b"), F.col("_c")))).alias("blank_crops"),
        F.sort_array(F.collect_list(F.when(F.col("_f"), F.struct(F.col("_c").alias("crop"), F.col("_r").alias("reasons"))))).alias("flagged_crops"),
    )


def volume_norm(crops: DataFrame, volume: str, aspect: Column, confident: Column, width: Column, height: Column) -> DataFrame:
    """Per volume: the median aspect of its confident crops (of all, if there are none) and a canvas of that aspect that holds every crop."""
    rows = crops.select(F.col(volume), aspect.alias("_a"), confident.alias("_c"), width.alias("_w"), height.alias("_h"))
    out = rows.groupBy(volume).agg(
        F.coalesce(F.median(F.when(F.col("_c"), F.col("_a"))), F.median("_a")).alias("norm"),
        F.max("_w").alias("_w"), F.max("_h").alias("_h"), F.count("*").alias("n"),
    )
    whole = lambda x: F.bround(x, 0).cast("long")
    out = out.withColumn("_cw", F.greatest(F.col("_w").cast("long"), whole(F.col("_h") * F.col("norm"))))
    out = out.withColumn("canvas_height", F.greatest(whole(F.col("_cw") / F.col("norm")), F.col("_h").cast("long")))
    return out.withColumn("canvas_width", F.greatest("_cw", whole(F.col("canvas_height") * F.col("norm")))).select(volume, "norm", "canvas_width", "canvas_height", "n")


def suspects(crops: DataFrame, norms: DataFrame, volume: str, aspect: Column, limit: float = 0.12) -> DataFrame:
    """Each crop's deviation from its volume's norm, and whether that is suspect."""
    out = crops.withColumn("_a", aspect).join(norms.select(volume, "norm"), volume)
    return out.withColumn("deviation", F.abs(F.col("_a") - F.col("norm"))).withColumn("suspect", F.col("deviation") > limit).drop("_a")


def volume_qa(crops: DataFrame, volume: str, source: Column, label: Column, aspect: Column, review: Column, blank: Column) -> DataFrame:
    rows = crops.select(F.col(volume), source.alias("_s"), label.alias("_l"), aspect.alias("_a"), review.alias("_r"), blank.alias("_b"))
    return rows.groupBy(volume).agg(
        F.countDistinct("_s").alias("images"), F.count("*").alias("folios"),
        F.count_if(F.col("_l") == "").alias("single"), F.count_if(F.col("_l") != "").alias("halves"),
        F.median("_a").alias("aspect_median"), F.min("_a").alias("aspect_min"), F.max("_a").alias("aspect_max"),
        F.count_if(F.col("_a") >= 1.0).alias("landscape"), F.count_if("_r").alias("review"), F.count_if("_b").alias("blank"),
    )


#: Bins of a histogram that the driver reads, and values that it sorts itself.
BINS, FEW = 4096, 10_000


def order_statistics(rows: DataFrame, value: str, ranks: list[int]) -> dict[int, float]:
    """The values at the given ranks (from 0) of a column without nulls, exactly and without sorting it.

    A histogram narrows the rank's range down until the values left in it are few or all the same."""
    out: dict[int, float] = {}
    v = F.col(value).cast("double")
    low, high, n = rows.agg(F.min(v), F.max(v), F.count("*")).first()
    left = [(low, high, 0, n, sorted(set(ranks)))] if n else []
    while left:
        low, high, below, n, wanted = left.pop()
        if low == high:
            out |= dict.fromkeys(wanted, low)
            continue
        inside = rows.where(v.between(low, high))
        if n <= FEW:
            found = sorted(r[0] for r in inside.select(v).collect())
            out |= {r: found[r - below] for r in wanted}
            continue
        place = F.least(F.floor((v - low) / (high - low) * BINS), F.lit(BINS - 1))
        for b in inside.groupBy(place.alias("b")).agg(F.min(v).alias("low"), F.max(v).alias("high"), F.count("*").alias("n")).orderBy("b").collect():
            if own := [r for r in wanted if below <= r < below + b["n"]]:
                left.append((b["low"], b["high"], below, b["n"], own))
            below += b["n"]
    return out


def percentiles(rows: DataFrame, value: str, shares: list[float]) -> list[float | None]:
    """Percentiles of a column, between two values in proportion; nulls do not count."""
    rows = rows.where(F.col(value).isNotNull())
    n = rows.count()
    places = [share * (n - 1) for share in shares]
    at = order_statistics(rows, value, [int(p) + k for p in places for k in (0, 1) if n and int(p) + k < n])
    return [None if not n else at[int(p)] + (at.get(int(p) + 1, at[int(p)]) - at[int(p)]) * (p - int(p)) for p in places]


def threshold_counts(rows: DataFrame, value: str, thresholds: list[float], group: list[str] | None = None) -> DataFrame:
    """How many values reach each threshold, with the median, the 90th and 99th percentile and the greatest value.

    A group's values are those of one volume; the percentiles of all rows come from histograms."""
    group, shares = group or [], [0.5, 0.9, 0.99]
    p = F.percentile(value, F.array(*map(F.lit, shares))) if group else F.array(*(F.lit(x).cast("double") for x in percentiles(rows, value, shares)))
    base = rows.groupBy(*group).agg(p.alias("p"), F.max(value).alias("greatest"), *[F.count_if(F.col(value) >= t).alias(f"_{i}") for i, t in enumerate(thresholds)])
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"_{i}").alias("reaching")) for i, t in enumerate(thresholds)])).alias("e")
    return base.select(*group, F.col("p")[0].alias("median"), F.col("p")[1].alias("p90"), F.col("p")[2].alias("p99"), "greatest", each).select(*group, "median", "p90", "p99", "greatest", "e.threshold", "e.reaching")


def confusion(pairs: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts of (truth, prediction) among rows whose truth is known."""
    return pairs.where(F.col(truth).isNotNull()).groupBy(truth, predicted).agg(F.count("*").alias("n"))


def accuracy(pairs: DataFrame, truth: Column, predicted: Column, *group: str) -> DataFrame:
    """Rows, labelled rows and accuracy among these, for each group and in all (group null)."""
    rows = pairs.withColumn("_ok", F.when(truth.isNotNull(), (truth == predicted).cast("int")))
    out = rows.rollup(*group) if group else rows
    return out.agg(F.count("*").alias("n"), F.count("_ok").alias("labelled"), F.avg("_ok").alias("accuracy"))


def latency(times: DataFrame, seconds: str, images: int, workers: list[int]) -> DataFrame:
    """Mean, median, least and greatest time of an image, throughput, and the hours that so many images take with so many workers."""
    middle = percentiles(times, seconds, [0.5])[0]
    base = times.agg(F.avg(seconds).alias("mean_s"), F.lit(middle).cast("double").alias("median_s"), F.min(seconds).alias("min_s"), F.max(seconds).alias("max_s"))
    out = base.withColumn("workers", F.explode(F.array(*map(F.lit, workers))))
    return out.withColumn("per_second", F.try_divide(F.col("workers"), F.col("mean_s"))).withColumn("hours", F.col("mean_s") * images / F.col("workers") / 3600)


def reason_counts(rows: DataFrame, reasons: Column) -> DataFrame:
    return rows.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def changed(before: DataFrame, after: DataFrame, key: str, value: str, group: str, least: float = 0.0, shape: list[str] | None = None) -> DataFrame:
    """Per group: rows in both sets, how many changed by more than ``least``, their share in percent and their keys.

    Rows that differ in a column of ``shape`` cannot be compared and are left out."""
    shape = shape or []
    both = before.select(group, key, F.col(value).alias("_a"), *shape).join(after.select(key, F.col(value).alias("_b"), *shape), [key, *shape])
    moved = F.abs(F.col("_a") - F.col("_b")) > least
    return both.groupBy(group).agg(F.count("*").alias("n"), F.count_if(moved).alias("changed"), (100.0 * F.count_if(moved) / F.count("*")).alias("percent"), F.sort_array(F.collect_list(F.when(moved, F.col(key)))).alias("names"))


def output_summary(crops: DataFrame, source: Column, page_count: Column, width: Column, height: Column, mean: Column, review: Column, blank: Column, placed: Column) -> DataFrame:
    """One row about an output folder: sources, crops by page count, review and blank counts, the aspects, the crops that
    look wrong (landscape, longer than the transcription backend takes, or dark) and those whose place in the source is known."""
    aspect, longest, shortest = width / height, F.greatest(width, height), F.least(width, height)
    rows = crops.select(source.alias("s"), page_count.alias("c"), aspect.alias("a"), ((aspect >= 1.0) | (longest > 2.41 * shortest) | (mean < 45)).alias("w"), review.alias("r"), blank.alias("b"), placed.alias("p"))
    return rows.agg(
        F.countDistinct("s").alias("sources"), F.count("*").alias("crops"), F.count_if(F.col("c") == "one_folio").alias("one_folio"), F.count_if(F.col("c") == "two_folios").alias("two_folios"),
        F.count_if("r").alias("needs_review"), F.count_if("b").alias("is_blank"), F.min("a").alias("aspect_min"), F.max("a").alias("aspect_max"),
        F.count_if(F.col("a") < 1).alias("portrait"), F.count_if("w").alias("odd"), F.count_if("p").alias("with_provenance"),
    )


def prefix_counters(crops: DataFrame, volume: str, source: str, review: Column, blank: Column) -> DataFrame:
    """Per volume: images, images with any flagged crop, and crops that are blank or flagged."""
    image = crops.groupBy(volume, source).agg(F.bool_or(review).alias("any"), F.count_if(blank).alias("_b"), F.count_if(review).alias("_f"))
    return image.groupBy(volume).agg(F.count("*").alias("images"), F.count_if("any").alias("review"), F.sum("_b").alias("blank"), F.sum("_f").alias("flagged"))


def legibility(words: DataFrame, page: str, text: Column, conf: Column) -> DataFrame:
    """How well each page reads: the sum of confidence times characters over the words that were read."""
    return words.groupBy(page).agg(F.coalesce(F.sum(conf * F.length(text)), F.lit(0.0)).alias("score"))


def outliers_left_out(boxes: DataFrame, page: str, outlier: float = 3.0) -> DataFrame:
    """The lines of each page without those much farther from the median centre than most are; of fewer than four all stay."""
    rows = boxes.withColumns({"_cx": (F.col("x0") + F.col("x1")) / 2, "_cy": (F.col("y0") + F.col("y1")) / 2})
    mid = rows.groupBy(page).agg(F.median("_cx").alias("_mx"), F.median("_cy").alias("_my"), F.count("*").alias("_n"))
    dx, dy = F.col("_cx") - F.col("_mx"), F.col("_cy") - F.col("_my")
    rows = rows.join(mid, page).withColumn("_d", F.sqrt(dx * dx + dy * dy))
    rows = rows.join(rows.groupBy(page).agg(F.median("_d").alias("_m")), page).withColumn("_o", F.abs(F.col("_d") - F.col("_m")))
    rows = rows.join(rows.groupBy(page).agg(F.median("_o").alias("_mad")), page)
    return rows.where((F.col("_n") < 4) | (F.col("_d") <= F.col("_m") + outlier * (F.col("_mad") + 1e-6))).select(*boxes.columns)


def text_region(boxes: DataFrame, page: str, width: Column, height: Column, margin: float = 0.02, trim: bool = False, least: float = 0.45, outlier: float = 3.0) -> DataFrame:
    """One box around all of a page's lines and a margin (a share of the page's diagonal), in whole pixels within the page.

    A page whose box is small against it is left out. With ``trim`` lines much farther from the median centre than most are."""
    rows = (outliers_left_out(boxes, page, outlier) if trim else boxes).withColumns({"_w": width, "_h": height})
    out = rows.groupBy(page).agg(F.max("_w").alias("_w"), F.max("_h").alias("_h"), *(best(c).alias(f"_{c}") for best, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))))
    pad = margin * F.hypot("_h", "_w")
    out = out.select(
        page, "_w", "_h", *(F.greatest(F.lit(0), F.floor(F.col(f"_{c}") - pad)).cast("long").alias(c) for c in ("x0", "y0")),
        F.least(F.col("_w").cast("long"), F.floor(F.col("_x1") + pad)).cast("long").alias("x1"), F.least(F.col("_h").cast("long"), F.floor(F.col("_y1") + pad)).cast("long").alias("y1"),
    )
    return out.where((F.col("x1") - F.col("x0") >= least * F.col("_w")) & (F.col("y1") - F.col("y0") >= least * F.col("_h"))).drop("_w", "_h")


def box_union(boxes: DataFrame, page: str, margin: float = 0.0, trim: float | None = None) -> DataFrame:
    """One box around all of a page's boxes (x0, y0, x1, y1); with ``trim`` without those whose centre lies more than so many median deviations off."""
    if trim is not None:
        boxes = boxes.withColumn("_y", (F.col("y0") + F.col("y1")) / 2)
        mid = boxes.groupBy(page).agg(F.median("_y").alias("_m"))
        boxes = boxes.join(mid, page).withColumn("_d", F.abs(F.col("_y") - F.col("_m")))
        spread = boxes.groupBy(page).agg(F.median("_d").alias("_s"))
        boxes = boxes.join(spread, page).where((F.col("_s") == 0) | (F.col("_d") <= trim * F.col("_s")))
    out = boxes.groupBy(page).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("n"))
    dx, dy = (F.col("x1") - F.col("x0")) * margin, (F.col("y1") - F.col("y0")) * margin
    return out.select(page, (F.col("x0") - dx).alias("x0"), (F.col("y0") - dy).alias("y0"), (F.col("x1") + dx).alias("x1"), (F.col("y1") + dy).alias("y1"), "n")


def coverage(rects: DataFrame, image: str, crop: tuple[Column, Column, Column, Column], grid: int = 1) -> DataFrame:
    """How much of the union of an image's rectangles a crop holds, and how much of the crop they fill.

    The union's area is exact. Between each two neighbouring left or right edges of an image's rectangles, those that
    reach over are passed in order of their upper edges, and what each adds to the length covered is summed up: no cell
    becomes a row, and an image takes space in proportion to its rectangles. One that lacks an edge covers nothing."""
    own = rects.withColumns({f"_c{i}": c for i, c in enumerate(crop)})
    box = F.struct(*(F.col(c).cast("double").alias(c) for c in ("y0", "y1", "x0", "x1")))
    g = own.groupBy(image, "_c0", "_c1", "_c2", "_c3").agg(F.sort_array(F.collect_list(F.when(F.col("y0").isNotNull() & F.col("y1").isNotNull() & F.col("x0").isNotNull() & F.col("x1").isNotNull(), box))).alias("r"))
    cx0, cy0, cx1, cy1 = (F.col(f"_c{i}").cast("double") for i in range(4))
    none, least = F.lit(0.0), F.lit(float("-inf"))
    start = F.struct(least.alias("end"), none.alias("all"), none.alias("held"))

    def lower(s: Column, r: Column, a: Column, b: Column) -> Column:
        """The state after a rectangle: how far down the strip is covered, and the lengths covered so far, in all and in the crop."""
        top = F.greatest(r["y0"], s["end"])
        more = F.struct(r["y1"].alias("end"), (s["all"] + r["y1"] - top).alias("all"), (s["held"] + F.greatest(none, F.least(r["y1"], cy1) - F.greatest(top, cy0))).alias("held"))
        return F.when((r["x0"] <= a) & (r["x1"] >= b) & (r["y1"] > top), more).otherwise(s)

    def strip(a: Column, b: Column) -> Column:
        """Areas of the strip from a to b that are covered, in all and in the crop."""
        width, held = b - a, F.greatest(none, F.least(b, cx1) - F.greatest(a, cx0))
        return F.aggregate("r", start, lambda s, r: lower(s, r, a, b), lambda s: F.struct((width * s["all"]).alias("all"), (held * s["held"]).alias("held")))

    g = g.withColumn("x", F.sort_array(F.array_distinct(F.concat("r.x0", "r.x1"))))
    g = g.withColumn("s", F.zip_with("x", F.slice("x", 2, F.greatest(F.size("x") - 1, F.lit(0))), lambda a, b: F.when(b.isNotNull(), strip(a, b))))
    total = lambda k: F.aggregate(F.col(f"s.{k}"), none, lambda t, v: t + F.coalesce(v, none))
    sums = g.select(image, total("all").alias("rects"), total("held").alias("held"), ((cx1 - cx0) * (cy1 - cy0)).alias("area"))
    return sums.select(image, F.coalesce(F.try_divide("held", "rects"), none).alias("coverage"), F.coalesce(F.try_divide("held", "area"), none).alias("meaningful"))
