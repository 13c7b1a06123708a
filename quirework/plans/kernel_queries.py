"""The pixel stages on made-up images whose answers have a closed form; one image for each row of ``nation``."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quirework.pixels import kernels as K
from quirework.pixels import stages as S
from quirework.plans import heads as H
from quirework.plans import models as M
from quirework.plans import pages as P
from quirework.plans.queries import query


def _each(t, answer: Callable[[int], dict], schema: str) -> DataFrame:
    """``answer`` of every nation key, where the rows are."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([{"k": int(k), **answer(int(k))} for k in frame["k"]], columns=["k", *(c.split(" ")[0] for c in schema.split(", "))])

    return t("nation").selectExpr("n_nationkey AS k").mapInPandas(run, f"k long, {schema}")


def _box(box: tuple | None) -> dict:
    return dict(zip(("x0", "y0", "x1", "y1"), (None,) * 4 if box is None else map(int, box), strict=True))


_CORNERS = "x0 long, y0 long, x1 long, y1 long"
_N = "(SELECT n_nationkey AS k FROM nation)"


def _rectangle(k: int, shape=(120, 160)) -> np.ndarray:
    m = np.zeros(shape, bool)
    m[10 + k : 70 + k, 20 + k : 100 + 2 * k] = True
    return m


@query(f"SELECT k, 20 + k AS x0, 10 + k AS y0, 99 + 2 * k AS x1, 69 + k AS y1, 20 + k - floor(0.1 * sqrt((79.0 + k) * (79.0 + k) + 59.0 * 59.0)) AS grown FROM {_N}")
def mask_quads(t):
    def answer(k):
        q, g = K.page_quad(_rectangle(k), 0.0), K.page_quad(_rectangle(k), 0.1)
        return _box((*np.rint(q[0]), *np.rint(q[2]))) | {"grown": float(np.ceil(g[0, 0] - 1e-9))}

    return _each(t, answer, f"{_CORNERS}, grown double")


@query(f"SELECT k, 4::BIGINT AS parts, (60 * (80 + k))::BIGINT AS largest, (60 * (80 + k) + 2 * (5 + k % 4) * 4)::BIGINT AS kept, (60 * (80 + k))::BIGINT AS filled FROM {_N}")
def mask_parts(t):
    """A large part with a hole, two small ones and a speck: labels, the largest, those of some size, and the hole filled."""

    def answer(k):
        m = _rectangle(k)
        hole = m.copy()
        hole[30 + k : 40 + k, 40 + k : 60 + k] = False
        for x in (2, 20):
            m[112:116, x : x + 5 + k % 4] = True
        m[118, 150] = True
        _, area = K.components(m)
        return {"parts": len(area) - 1, "largest": int(K.largest(m).sum()), "kept": int(K.keep_components(m, 4).sum()), "filled": int(K.filled(hole).sum())}

    return _each(t, answer, "parts long, largest long, kept long, filled long")


@query(f"SELECT k, (40 * (90 + k))::BIGINT AS safe, (40 * 30 + 40 * 30)::BIGINT AS parts FROM {_N}")
def safe_masks(t):
    """Two blocks side by side: the hull bridges the bay between them."""

    def answer(k):
        m = np.zeros((80, 200), bool)
        m[20:60, 10:40] = m[20:60, 70 + k : 100 + k] = True
        return {"safe": int(S.safe_mask(m).sum()), "parts": int(m.sum())}

    return _each(t, answer, "safe long, parts long")


@query(f"""WITH d AS (SELECT k, sqrt((90.0 + k) * (90.0 + k) + 119.0 * 119.0) AS d FROM {_N}), g AS (SELECT k, greatest(1, floor(0.045 * d)) AS m, greatest(1, floor(0.02 * d)) AS s FROM d)
SELECT k, (20 - m)::BIGINT AS x0, (20 - m)::BIGINT AS y0, (110 + k + s + 1)::BIGINT AS x1, (140 + m)::BIGINT AS y1 FROM g""")
def seam_sides(t):
    """The left page of a spread: a margin around it, but over the seam only the slack."""

    def answer(k):
        m = np.zeros((160, 260), bool)
        m[20:140, 20:240] = True
        return _box(K.bounds(S.side_mask(m, np.full(160, 110 + k), True, 0.045, 0.02)))

    return _each(t, answer, _CORNERS)


@query(f"""WITH b AS (SELECT k, 60 + 4 * k AS w, 50 AS h, 30 + 2 * k AS y0 FROM {_N}), e AS (SELECT *, greatest(0, round_even(w / 0.8, 0) - h)::BIGINT AS x FROM b)
SELECT k, 40::BIGINT AS x0, (y0 - x // 2)::BIGINT AS y0, (40 + w)::BIGINT AS x1, (y0 + h + x - x // 2)::BIGINT AS y1 FROM e""")
def masks_extended(t):
    def answer(k):
        m = np.zeros((300, 260), bool)
        m[30 + 2 * k : 80 + 2 * k, 40 : 100 + 4 * k] = True
        # moved down, so that there is room on both sides
        m = np.roll(m, 70, axis=0)
        x0, y0, x1, y1 = K.bounds(S.extended(m, 0.8))
        return _box((x0, y0 - 70, x1, y1 - 70))

    return _each(t, answer, _CORNERS)


def _sheet(k: int) -> np.ndarray:
    x = np.full((300, 260, 3), 20, np.uint8)
    x[30 + k : 260, 25 : 200 + k] = 230
    return x


# The dark table beside the sheet counts as ink: within the dilated sheet (5 pixels of 4 % of 260), or within the window of the local threshold (7 of 15).
_PAD = "(5 + floor(0.012 * sqrt(300.0 * 300.0 + 260.0 * 260.0)))::BIGINT"


@query(f"SELECT k, 25 - {_PAD} AS x0, 30 + k - {_PAD} AS y0, 200 + k + {_PAD} AS x1, 260 + {_PAD} AS y1 FROM {_N}")
def paper_boxes(t):
    """A bright sheet on a dark table: its box, the ink on it and the margin."""
    return _each(t, lambda k: _box(S.paper_box(_sheet(k))), _CORNERS)


_TRIM = "(7 + floor(0.01 * sqrt(300.0 * 300.0 + 260.0 * 260.0)))::BIGINT"


@query(f"SELECT k, 25 - {_TRIM} AS x0, 30 + k - {_TRIM} AS y0, 200 + k + {_TRIM} AS x1, 260 + {_TRIM} AS y1 FROM {_N}")
def borders_trimmed(t):
    return _each(t, lambda k: _box(S.trim_border(_sheet(k))), _CORNERS)


@query(f"SELECT k, 12 + k % 7 AS x0, 20 + k % 5 AS y0, CASE WHEN k >= 14 THEN 140 + k ELSE 138 END::BIGINT AS x1, 180::BIGINT AS y1, CASE WHEN k >= 14 THEN 2 ELSE 1 END::BIGINT AS boxes FROM {_N}")
def page_boxes(t):
    """The first page box of the scenes: from k = 14 on it ends at the fold."""
    from quirework.plans.file_queries import _scene

    def answer(k):
        boxes, _, _ = S.detect(_scene(k), 2)
        return _box(boxes[0]) | {"boxes": len(boxes)}

    return _each(t, answer, f"{_CORNERS}, boxes long")


@query(f"SELECT k, 10::BIGINT AS x0, 10::BIGINT AS y0, CASE WHEN k % 2 = 0 THEN 186 - k % 5 ELSE 210 END::BIGINT AS x1, 290::BIGINT AS y1 FROM {_N}")
def facing_strips(t):
    """Pages with a dark fold and a narrow strip of the facing page near the right border (even k): the strip goes."""

    def answer(k):
        x = np.full((300, 220, 3), 20, np.uint8)
        x[10:290, 10:210] = 235
        if k % 2 == 0:
            x[10:290, 184 - k % 5 : 189 - k % 5] = 130
        box = S.detect(x, 1)[0][0]
        want = 186 - k % 5
        return _box((*box[:2], want if k % 2 == 0 and abs(box[2] - want) <= 1 else box[2], box[3]))

    return _each(t, answer, _CORNERS)


@query(f"SELECT k, 118 + k AS mean_x, 0::BIGINT AS bend, 200::BIGINT AS rows FROM {_N}")
def gutter_lines(t):
    """A straight fold between two boxes that touch: the seam runs along its middle."""

    def answer(k):
        x = np.full((200, 260, 3), 230, np.uint8)
        x[:, 115 + k : 122 + k] = 120
        line = S.gutter(x, [(0, 0, 118 + k, 200), (118 + k, 0, 260, 200)])
        return {"mean_x": int(round(float(line.mean()))), "bend": int(np.abs(np.diff(line)).sum()), "rows": len(line)}

    return _each(t, answer, "mean_x long, bend long, rows long")


@query(f"SELECT k, (CASE WHEN k % 3 = 0 THEN 0 ELSE k % 7 - 3 END)::BIGINT AS degrees FROM {_N}")
def skews(t):
    """Lines of text turned by whole degrees; a page without text is not turned at all."""

    def answer(k):
        g = np.full((420, 300), 240, np.uint8)
        if k % 3:
            for y in range(40, 380, 16):
                for x in range(40, 250, 14):
                    g[y : y + 4, x : x + 9] = 40
        turn, w, h = K.rotation(300, 420, -(k % 7 - 3) if k % 3 else 0)
        found = S.skew(K.warp(g, turn, w, h))
        return {"degrees": round(found) if abs(found - round(found)) < 0.3 else 99}

    return _each(t, answer, "degrees long")


@query(f"SELECT k, 30::BIGINT AS x0, 40::BIGINT AS y0, (30 + 60 + k)::BIGINT AS x1, (40 + 50)::BIGINT AS y1, 3::BIGINT AS boxes FROM {_N}")
def entry_regions(t):
    """Three entries in a probability map in reading order: the first line from left to right, then the next; specks do not count."""

    def answer(k):
        p = np.zeros((400, 500))
        for x, y in ((250, 45), (30, 40), (30, 200)):
            p[y : y + 50, x : x + 60 + k] = 0.9
        p[390:393, 490:493] = 1
        boxes = S.entry_boxes(p)
        return _box(boxes[0]) | {"boxes": len(boxes)}

    return _each(t, answer, f"{_CORNERS}, boxes long")


@query(f"""SELECT k, (10 * (40 + k) / (10.0 * (40 + k) + 400)) AS share, (10 * (40 + k) / (10.0 * (40 + k) + 400)) AS central, 0.0 AS interior, 10 * (40 + k) / 40000.0 AS white FROM {_N}""")
def white_outs(t):
    """A block of ink that a white-out took, reached from the border by white, and one that stayed."""

    def answer(k):
        before = np.full((200, 200), 200.0)
        before[60:70, 60 : 100 + k] = before[120:140, 60:80] = 30
        after = before.copy()
        after[60:70, 60 : 100 + k] = 255
        got = S.erased_ink(before, after)
        lines = after.copy()
        lines[:60, 60] = 255  # a white way to the border
        return {"share": got["share"], "central": got["central"], "interior": S.erased_ink(before, lines)["interior"], "white": S.white_fraction(after)}

    return _each(t, answer, "share double, central double, interior double, white double")


@query(f"SELECT k, (30 + k) / 100.0 AS outside, CASE WHEN k % 2 = 0 THEN 1.0 ELSE 0.0 END AS ring FROM {_N}")
def clipped_crops(t):
    """A crop that leaves some columns of the page's ink out, found by its pattern; and ink in the band around a quad, or none."""

    def answer(k):
        rng = np.random.default_rng(k)
        whole = rng.integers(120, 250, (90, 140)).astype(float)
        page = np.full(whole.shape, 255.0)
        page[20:60, 20:120] = 30
        crop = whole[10:80, : 90 - k]
        outside, _ = S.clipped_ink(page, whole, crop, 140)
        photo = np.full((200, 200, 3), 230, np.uint8)
        quad = np.array([[0.3, 0.3], [0.7, 0.3], [0.7, 0.7], [0.3, 0.7]])
        if k % 2 == 0:
            photo[:] = 20
        return {"outside": outside, "ring": S.outside_ink(photo, quad)}

    return _each(t, answer, "outside double, ring double")


@query(f"SELECT k, ((60 + (60 + 2 * k + 100)) // 2 * 50)::BIGINT AS first_area, 50 * 260 - ((60 + (60 + 2 * k + 100)) // 2 * 50)::BIGINT AS second_area, 1.0 AS overlap, 1.0 AS faded FROM {_N}")
def page_territories(t):
    """A learned mask over two boxes is cut half-way between their centres; a finder that sees the page at every fade has no loss."""

    def answer(k):
        mask = np.ones((50, 260), bool)
        a, b = S.territories(mask, [(20, 0, 100, 50), (120 + 2 * k, 0, 200 + 2 * k, 50)])
        x = np.full((50, 260, 3), 90, np.uint8)
        found = S.faded_overlap(x, mask, lambda image: (image[..., 0] < 255).astype(int))
        return {"first_area": int(a.sum()), "second_area": int(b.sum()), "overlap": found[1.0], "faded": min(found.values())}

    return _each(t, answer, "first_area long, second_area long, overlap double, faded double")


@query(f"SELECT k, 'hybrid + trained orientation + landscape pre-pass + reading rescue + blank verdict' AS mode, 'two_folios' AS count, k % 2 = 0 AS escalated, 0.75 AS upright, 3 * (4 + k)::DOUBLE AS legible FROM {_N}")
def composed_heads(t):
    """The heads that given models allow: what they are called, and how the hybrid ones answer."""

    def answer(k):
        mask = lambda image: np.zeros(image.shape[:2]) if k % 2 == 0 else np.ones(image.shape[:2])
        asked: list[int] = []

        def escalate(image, box):
            asked.append(1)
            return np.ones(image.shape[:2])

        h, mode = H.composed(page_mask=mask, count=lambda x: ("one_folio", 0.6), flip=lambda x: (False, 0.75), escalate=escalate, orient=lambda x: np.array([0.75, 0.0, 0.25, 0.0]), reader=lambda x: [("abcd" + "x" * k, 3.0)], blank=lambda x: (False, 0.1))
        wide = np.full((60, 90, 3), 200, np.uint8)
        h.segmenter.masks(wide, [(0, 0, 90, 60)])
        return {"mode": mode, "count": h.counter.predict(wide)[0], "escalated": bool(asked), "upright": float(h.orienter.probs(wide)[0]), "legible": h.reader(wide)}

    return _each(t, answer, "mode string, count string, escalated boolean, upright double, legible double")


@query(f"SELECT k, 'one_folio' AS page_count, true AS tight, k % 2 = 0 AS white, true AS flattened FROM {_N}")
def learned_mask_branches(t):
    """A page under a learned mask: cut to the mask's box, or everything beyond it white; a curved page goes to the dewarper."""
    from quirework.config import Geometry, Settings

    def answer(k):
        x = np.full((260, 200, 3), 120, np.uint8)
        x[40:220, 50:150] = 230
        mask = np.zeros((260, 200), bool)
        y = 40 + (np.arange(200) > 100) * 20  # a bent upper edge
        for c in range(50, 150):
            mask[y[c] : 220, c] = True
        flat: list[int] = []

        def dewarp(image):
            flat.append(1)
            return image

        h = H.Heads(H.ClassicalSegmenter(), type("One", (), {"predict": lambda s, i: ("one_folio", 0.9)})(), H.ClassicalOrienter(), learned_mask=lambda image: mask, dewarp=dewarp)
        r = P.process(x, h, Settings(geometry=Geometry(white_out=k % 2 == 0, dewarp=True)))
        crop = r.pages[0].crop
        return {"page_count": r.page_count, "tight": bool(k % 2 == 0 or crop.shape[1] < 120), "white": bool((crop[:4] == 255).all()), "flattened": bool(flat)}

    return _each(t, answer, "page_count string, tight boolean, white boolean, flattened boolean")


# ---------------------------------------------------------------- networks behind functions (toy ones here)
@query(f"""WITH v AS (SELECT k, (40 + 8 * k)::DOUBLE AS v FROM {_N}), x AS (SELECT k, v, v / 255 AS p FROM v)
SELECT k, round((p - 0.485) / 0.229, 4) AS red, CASE WHEN v > 150 THEN 'two_folios' ELSE 'one_folio' END AS label, round(1 / (1 + exp(-abs(v - 150) / 10)), 4) AS conf, v > 150 AS blank, 2.0 AS aspect, 1.0 AS valley FROM x""")
def classifier_heads(t):
    """Images of one brightness: what the network is given, and the label, probability and blank verdict read from its logits."""

    def answer(k):
        x = np.full((60, 120, 3), 40 + 8 * k, np.uint8)
        net = lambda batch, *_: np.array([[0.0, (float(batch[0, 0].mean()) * M.STD[0] + M.MEAN[0]) * 25.5 - 15]])
        head = M.Classifier(net, ("one_folio", "two_folios"), with_priors=True)
        label, conf = head.predict(x)
        aspect, valley = M.geometric_priors(x)
        return {"red": round(float(M.prepared(x, 8)[0, 0, 0, 0]), 4), "label": label, "conf": round(conf, 4), "blank": head.blank(x)[0], "aspect": float(aspect), "valley": round(float(valley), 6)}

    return _each(t, answer, "red double, label string, conf double, blank boolean, aspect double, valley double")


@query(f"""SELECT k, ((64 - k) * 64)::BIGINT AS page, round(100.0 * (64 - k) / 64, 6) AS coverage, k::BIGINT AS x0, 0::BIGINT AS y0, 128::BIGINT AS x1, 192::BIGINT AS y1 FROM {_N}""")
def mask_heads(t):
    """A network that sees a page from column k on; the old network's mask and box at another size than the image's."""

    def answer(k):
        x = np.full((64, 64, 3), 20, np.uint8)
        x[:, k:] = 220
        sees = lambda batch: (batch[:, :1] * M.STD[0] + M.MEAN[0] - 0.45) * 50
        mask = M.PageMask(sees, 64)
        old = M.OldPageMask(lambda batch: np.stack([0.4 - batch[:, 0], batch[:, 0] - 0.4], axis=1), (64, 96))
        y = np.full((192, 128, 3), 20, np.uint8)
        y[:, k:] = 220
        box = old.box(y)
        # the reduced image holds every second column
        return {"page": int(mask(x).sum()), "coverage": round(mask.coverage(x), 6)} | _box((k if abs(box[0] - k) <= 1 else box[0], *box[1:]))

    return _each(t, answer, f"page long, coverage double, {_CORNERS}")


@query(f"SELECT k, '10;80' AS lefts, 2::BIGINT AS boxes, (30 * 40)::BIGINT AS area FROM {_N}")
def prompted_segmenter(t):
    """The two best of three boxes from left to right, and the mask of the first."""

    def answer(k):
        found = [(80, 5, 110, 45, 0.9), (50, 0, 60, 10, 0.1 + k / 100), (10, 5, 40, 45, 0.8)]

        def prompted(image, box):
            m = np.zeros(image.shape[:2])
            m[box[1] : box[3], box[0] : box[2]] = 1
            return m

        s = M.PromptedSegmenter(lambda image: found, prompted)
        boxes = s.detect(np.zeros((60, 130, 3), np.uint8), 2)
        return {"lefts": ";".join(str(b[0]) for b in boxes), "boxes": len(boxes), "area": int(s.masks(np.zeros((60, 130, 3), np.uint8), boxes)[0].sum())}

    return _each(t, answer, "lefts string, boxes long, area long")


@query(f"""SELECT k, CASE WHEN k % 2 = 0 THEN 'A;B' ELSE '' END AS labels, CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS crops, CASE WHEN k % 2 = 0 THEN (200 + k) // 2 + floor(0.05 * (200 + k)) ELSE 100 END::BIGINT AS width, k % 3 = 0 AS turned FROM {_N}""")
def baseline_pages(t):
    """The old method on an open spread that stands upright (even k) and on a sideways page: both are turned first."""

    def answer(k):
        x = np.zeros((200 + k, 100, 3), np.uint8) if k % 2 == 0 else np.zeros((100, 200 + k, 3), np.uint8)
        turned: list[int] = []

        def flip(part):
            turned.append(1)
            return ("upside_down" if k % 3 == 0 else "right_side", 0.9)

        marked = x.copy()
        marked[:10] = 200
        out = M.baseline(marked, lambda i: ("two_folios" if k % 2 == 0 else "one_folio", 0.9), flip, lambda part: (0, 0, part.shape[1], part.shape[0]))
        plain = M.baseline(marked, lambda i: ("two_folios" if k % 2 == 0 else "one_folio", 0.9), lambda p: ("right_side", 0.9), lambda part: (0, 0, part.shape[1], part.shape[0]))
        return {"labels": ";".join(label for label, _ in out), "crops": len(out), "width": out[0][1].shape[1], "turned": bool((out[0][1] == np.rot90(plain[0][1], 2)).all() and k % 3 == 0)}

    return _each(t, answer, "labels string, crops long, width long, turned boolean")


@query(f"SELECT k, ((25 + 5) * (1 + (2 + k % 4) // 3) + 5)::BIGINT AS height, (3 * 30 + 5)::BIGINT AS width, 100::BIGINT AS first FROM {_N}")
def montages(t):
    """Three to six plain images in a grid of three columns."""

    def answer(k):
        grid = M.montage([np.full((10, 20, 3), 100 + i, np.uint8) for i in range(3 + k % 4)], 3, cell=25, pad=5)
        return {"height": grid.shape[0], "width": grid.shape[1], "first": int(grid[5 + 12, 5 + 12, 0])}

    return _each(t, answer, "height long, width long, first long")


@query(f"SELECT k, true AS same_again, true AS same_shape, true AS binary FROM {_N}")
def augmentations(t):
    """Training pairs varied by a seed: the same seed gives the same pair."""

    def answer(k):
        x, m = np.random.default_rng(k).integers(0, 255, (40, 50, 3), dtype=np.uint8), np.zeros((40, 50), bool)
        m[10:30, 10:40] = True
        (a, p), (b, q) = M.augmented(x, m, k), M.augmented(x, m, k)
        return {"same_again": bool((a == b).all() and (p == q).all()), "same_shape": a.shape == x.shape and p.shape == m.shape, "binary": p.dtype == bool}

    return _each(t, answer, "same_again boolean, same_shape boolean, binary boolean")
