"""Quality gates and decisions on scores, as column expressions with the thresholds of :mod:`quirework.config`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.config import Quality
from quirework.functions.tiles import let, total

Q = Quality()


def reasons(*cases: tuple[Column, str]) -> Column:
    """The names of the conditions that hold, in order; a null condition does not hold."""
    return F.filter(F.array(*[F.when(c, F.lit(name)) for c, name in cases]), lambda x: x.isNotNull())


def review_reasons(text_frac: Column, orientation_conf: Column, area_frac: Column, aspect: Column, q: Quality = Q) -> Column:
    return reasons(
        (text_frac < q.min_text_frac, "low_text_for_orientation"),
        (orientation_conf < q.min_orientation_conf, "low_orientation_conf"),
        (area_frac < q.min_area_frac, "page_too_small"),
        ((aspect < q.aspect_low) | (aspect > q.aspect_high), "unexpected_aspect"),
    )


def image_error(height: Column, page_count: Column, boxes: Column, folios: Column) -> Column:
    """Why an image has no pages; null if it has."""
    return F.when(height.isNull() | (height <= 0), "decode_failed").when(page_count == "reject", "rejected_non_page").when(boxes == 0, "no_page_detected").when(folios == 0, "no_valid_folio")


def is_faint(text_frac: Column, is_blank: Column) -> Column:
    return (text_frac < 0.12) & ~is_blank


# ---------------------------------------------------------------- orientation
def argmax(p: Column) -> Column:
    """Position from 0 of the greatest entry, the first of equals."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def top_two(p: Column) -> Column:
    """struct<k, top, k2, second, margin>."""
    k = argmax(p)
    rest = F.transform(p, lambda x, i: F.when(i == k, F.lit(float("-inf"))).otherwise(x))
    top, second = F.array_max(p), F.array_max(rest)
    return F.struct(k.alias("k"), top.alias("top"), argmax(rest).alias("k2"), second.alias("second"), (top - second).alias("margin"))


def prepass_turn(p: Column, least: float = 0.5) -> Column:
    """Quarter turns to undo before anything else: sideways scans only, and only if sure."""
    k = argmax(p)
    return F.when(k.isin(1, 3) & (F.array_max(p) >= least), k).otherwise(0)


def quarter_turn(p: Column, score_top: Column, score_second: Column, margin: float = 0.15) -> Column:
    """struct<k, conf>: the top entry, or of two close ones that with the better text-line score; the confidence is the top one's."""
    t = top_two(p)
    return F.struct(F.when((t["margin"] >= margin) | (score_top >= score_second), t["k"]).otherwise(t["k2"]).alias("k"), t["top"].alias("conf"))


def undo_turn(k: Column) -> Column:
    return F.pmod(-k, F.lit(4)).cast("int")


def applied_quarters(pre_k: Column, rotation_deg: Column) -> Column:
    return F.pmod(pre_k + F.bround(rotation_deg / 90, 0).cast("int"), F.lit(4)).cast("int")


def softmax(x: Column) -> Column:
    e = let(F.array_max(x), lambda top: F.transform(x, lambda v: F.exp(v - top)))
    return let(e, lambda e: let(total(e), lambda s: F.transform(e, lambda v: v / s)))


def flip_margin(up: Column, down: Column) -> Column:
    return F.coalesce(F.try_divide(F.abs(up - down), up + down), F.lit(0.0))


def rescue_by_reading(found: Column, up: Column, down: Column, rotation_deg: Column, confirm: float = 0.20, override: float = 0.35) -> Column:
    """struct<margin, flip, confirmed, flipped, rotation_deg, reasons>: legibility of a page and of the page upside down.

    Only pages with a doubtful orientation are read. Upright ones are confirmed from ``confirm`` on; those
    that read better upside down are turned from ``override`` on. Either clears the doubt."""
    doubt = F.array_contains(found, "low_orientation_conf")
    margin, flip = flip_margin(up, down), down > up
    confirmed, flipped = doubt & ~flip & (margin >= confirm), doubt & flip & (margin >= override)
    turned = F.pmod(rotation_deg + 180, F.lit(360.0))
    return F.struct(
        margin.alias("margin"), flip.alias("flip"), confirmed.alias("confirmed"), flipped.alias("flipped"),
        F.when(flipped, turned).otherwise(rotation_deg).alias("rotation_deg"),
        F.when(confirmed | flipped, F.array_remove(found, "low_orientation_conf")).otherwise(found).alias("reasons"),
    )


def osd_probs(rotate: Column, conf: Column, least: float = 2.0) -> Column:
    """Four orientation probabilities from a page reader's (rotate, confidence); even where it is not sure."""
    k = F.when(rotate == 0, 0).when(rotate == 90, 3).when(rotate == 180, 2).when(rotate == 270, 1)
    peak = F.greatest(F.lit(0.5), F.least(F.lit(0.9), 0.5 + conf / 20))
    sure = k.isNotNull() & (conf >= least)
    return F.array(*[F.when(~F.coalesce(sure, F.lit(False)), 0.25).when(k == i, peak).otherwise((1 - peak) / 3) for i in range(4)])


def upright_only(p: Column) -> Column:
    """Without the sideways entries, renormalised."""
    both = p[0] + p[2]
    return F.array(F.try_divide(p[0], both), F.lit(0.0), F.try_divide(p[2], both), F.lit(0.0))


def ink_centroid_probs(ink: Column, up: Column, down: Column) -> Column:
    """Orientation from where the ink lies: ``up`` and ``down`` are the shares of the two halves."""
    upright, turned = F.when(ink > 50, 0.2 + 0.6 * up).otherwise(0.40), F.when(ink > 50, 0.2 + 0.6 * down).otherwise(0.10)
    both = upright + turned
    return F.array(upright / both, F.lit(0.0), turned / both, F.lit(0.0))


def legacy_orientation(p_down: Column, width: Column, height: Column) -> Column:
    raw = F.when(width > 1.15 * height, F.array(*map(F.lit, (0.1, 0.4, 0.1, 0.4)))).otherwise(F.array(1 - p_down, F.lit(0.0), p_down, F.lit(0.0)))
    return let(raw, lambda r: let(total(r), lambda s: F.transform(r, lambda v: v / s)))


def legacy_turn(two: Column, width: Column, height: Column) -> Column:
    """Quarter turns of the old baseline: an upright spread or a sideways page is turned by three."""
    return F.when(F.when(two, height > width).otherwise(width > height), 3).otherwise(0)


def masks_used(learned_share: Column, least: float = 0.05) -> Column:
    """Whether the learned mask replaces the others: only if it covers anything to speak of."""
    return F.coalesce(learned_share > least, F.lit(False))


# ---------------------------------------------------------------- page count
def two_pages(width: Column, height: Column, shadow: Column) -> Column:
    """The geometric rule for an open spread."""
    return (width > 1.15 * height) | ((width > 1.05 * height) & (shadow < 0.92))


def legacy_count(predicted: Column, conf: Column, width: Column, height: Column, shadow: Column, sure: float = 0.75) -> Column:
    rule = F.when(two_pages(width, height, shadow), "two_folios").otherwise("one_folio")
    return F.when(conf < sure, rule).otherwise(predicted)


def classical_count(boxes: Column, valley: Column) -> Column:
    """struct<page_count, conf> from the number of page boxes and the depth of the valley between them."""
    clip = lambda x: F.greatest(F.lit(0.5), F.least(F.lit(0.99), x))
    return F.struct(
        F.when(boxes == 0, "reject").when(boxes == 2, "two_folios").otherwise("one_folio").alias("page_count"),
        F.when(boxes == 0, 0.5).when(boxes == 2, clip(1 - valley)).otherwise(clip(valley)).alias("conf"),
    )


# ---------------------------------------------------------------- geometry on columns
def halves(width: Column, height: Column, overlap: float = 0.04) -> Column:
    """The two page boxes of a full frame, with some overlap on each side of the middle."""
    extra, mid = F.floor(width * overlap), F.floor(width / 2)
    box = lambda a, b: F.struct(a.cast("int").alias("x1"), F.lit(0).alias("y1"), b.cast("int").alias("x2"), height.cast("int").alias("y2"))
    return F.array(box(F.lit(0), F.least(width, mid + extra)), box(F.greatest(F.lit(0), mid - extra), width))


def gutter_band(left_x1: Column, left_x2: Column, right_x1: Column, right_x2: Column, width: Column, margin: float = 0.04, half: float = 0.08, least: int = 8) -> Column:
    """struct<low, high>: where the seam between two page boxes is looked for; boxes that touch or overlap give a band about their middle."""
    middle = F.floor((left_x1 + left_x2 + right_x1 + right_x2) / 4)
    reach = F.greatest(F.floor(half * width), F.lit(least))
    apart, pad = right_x1 > left_x2, F.floor(margin * width)
    return F.struct(
        F.greatest(F.lit(0), F.when(apart, left_x2 - pad).otherwise(middle - reach)).cast("long").alias("low"),
        F.least(width, F.when(apart, right_x1 + pad).otherwise(middle + reach)).cast("long").alias("high"),
    )


def crop_box(candidate: Column, width: Column, height: Column) -> Column:
    """A candidate crop (struct of x0, y0, x1, y1), or the full frame where the method finds none."""
    full = F.struct(F.lit(0).cast("long").alias("x0"), F.lit(0).cast("long").alias("y0"), width.cast("long").alias("x1"), height.cast("long").alias("y1"))
    return F.coalesce(candidate, full)


def canvas_place(width: Column, height: Column, canvas_width: Column, canvas_height: Column) -> Column:
    """struct<x, y>: where a crop stands in the middle of its volume's canvas."""
    return F.struct(F.floor((canvas_width - width) / 2).alias("x"), F.floor((canvas_height - height) / 2).alias("y"))


def straight_size(quad: Column) -> Column:
    """struct<width, height> of the upright page that a quad (TL, TR, BR, BL) is straightened to."""
    side = lambda a, b: F.hypot(quad[a]["x"] - quad[b]["x"], quad[a]["y"] - quad[b]["y"])
    whole = lambda x: (F.bround(x, 0) + 1).cast("long")
    return F.struct(whole(F.greatest(side(0, 1), side(3, 2))).alias("width"), whole(F.greatest(side(0, 3), side(1, 2))).alias("height"))


def turned_size(width: Column, height: Column, degrees: Column) -> Column:
    """struct<width, height> of the frame that holds an image after a rotation."""
    c, s = F.abs(F.cos(F.radians(degrees))), F.abs(F.sin(F.radians(degrees)))
    return F.struct(F.bround(height * s + width * c, 0).cast("long").alias("width"), F.bround(height * c + width * s, 0).cast("long").alias("height"))


def partial_spread(aspect: Column, ink: Column, ratio: Column, at: Column, high: float = 0.95, least_ink: float = 0.02, least_ratio: float = 1.5, least_side: float = 0.2, target: float = 0.77) -> Column:
    """struct<why, kept, aspect_after>: a crop that also shows part of the facing page is cut at the spine.

    ``at`` is the spine's place from 0 to 1. The side whose aspect is nearer to the target stays, the left
    one if both are alike; sides that are too narrow are no choice."""
    left, right = aspect * at, aspect * (1 - at)
    off = lambda side, share: F.when(share >= least_side, F.abs(side - target))
    a, b = off(left, at), off(right, 1 - at)
    why = F.when(aspect <= high, "aspect_in_range").when(ink < least_ink, "too_little_ink").when(at.isNull() | (ratio < least_ratio), "no_confident_spine").when(a.isNull() & b.isNull(), "no_side_wide_enough")
    kept = F.when(why.isNull(), F.when(b.isNull() | (a <= b), "left").otherwise("right"))
    return F.struct(F.coalesce(why, F.lit("fired")).alias("why"), kept.alias("kept"), F.when(kept == "left", left).when(kept == "right", right).alias("aspect_after"))


def split_quad(quad: Column, t: Column, left: Column) -> Column:
    """The part of a quad (TL, TR, BR, BL) on one side of the line at the share t of its width."""
    point = lambda a, b: F.struct(*[(a[c] + (b[c] - a[c]) * t).alias(c) for c in ("x", "y")])
    top, bottom = point(quad[0], quad[1]), point(quad[3], quad[2])
    return F.when(left, F.array(quad[0], top, bottom, quad[3])).otherwise(F.array(top, quad[1], quad[2], bottom))


def order_quad(points: Column) -> Column:
    """Corners as TL, TR, BR, BL by their sums and differences; the first of equals."""
    pick = lambda key, best: F.element_at(points, F.array_position(F.transform(points, key), best(F.transform(points, key))).cast("int"))
    along, slope = lambda p: p["x"] + p["y"], lambda p: p["y"] - p["x"]
    return F.array(pick(along, F.array_min), pick(slope, F.array_min), pick(along, F.array_max), pick(slope, F.array_max))


def unrotate_point(x: Column, y: Column, k: Column, width: Column, height: Column) -> Column:
    """A point of an image after k counter-clockwise quarter turns, in the original of that width and height."""
    ux = F.when(k == 0, x).when(k == 1, width - 1 - y).when(k == 2, width - 1 - x).otherwise(y)
    uy = F.when(k == 0, y).when(k == 1, x).when(k == 2, height - 1 - y).otherwise(height - 1 - x)
    return F.struct(ux.alias("x"), uy.alias("y"))


def padded_size(width: Column, height: Column, ratio: float = 2.4) -> Column:
    """struct<width, height> after padding the short side until long : short is at most ``ratio``."""
    short = lambda long: F.ceil(long / ratio)
    return F.struct(
        F.when(height > ratio * width, short(height)).otherwise(width).cast("long").alias("width"),
        F.when(width > ratio * height, short(width)).otherwise(height).cast("long").alias("height"),
    )


def page_extent(top: Column, bottom: Column, width: Column, height: Column, high: float = 0.80) -> Column:
    """struct<top, bottom>: a page box made tall enough for its width, within the frame; room missing on one side is taken on the other."""
    need = F.least(height, F.bround(width / high))
    extra = F.greatest(F.lit(0), need - (bottom - top))
    up = F.least(top, F.floor(extra / 2))
    down = F.least(height - bottom, extra - up)
    up = F.least(top, extra - down)
    return F.struct((top - up).cast("long").alias("top"), (bottom + down).cast("long").alias("bottom"))


def shape_flags(aspect: Column, width: Column, height: Column, mean: Column, white: Column) -> Column:
    """What looks wrong about a crop."""
    return reasons((aspect < 0.5, "sliver"), (aspect >= 1.0, "landscape"), (F.least(width, height) < 200, "tiny"), (mean < 70, "dark"), (white > 0.55, "mostly-white"))
