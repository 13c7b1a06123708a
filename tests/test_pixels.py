import numpy as np
import pytest

from quirework.pixels import kernels as K
from quirework.pixels import stages as S


def spread(middle=200, bend=0, w=400, h=300):
    rng = np.random.default_rng(0)
    x = np.clip(235 + rng.normal(0, 8, (h, w, 3)), 0, 255)
    at = (middle + bend * np.sin(np.linspace(0, np.pi, h))).astype(int)
    for y in range(h):
        x[y, at[y] - 3 : at[y] + 3] = 30
    return x.astype(np.uint8), at


@pytest.mark.parametrize("middle", [200, 140])
def test_gutter(middle):
    x, _ = spread(middle)
    line = S.gutter(x, [(0, 0, middle, 300), (middle, 0, 400, 300)])
    assert abs(np.median(line) - middle) <= 8 and np.abs(np.diff(line)).max() <= 1


def test_curved_gutter():
    x, at = spread(190, 20)
    line = S.gutter(x, [(0, 0, 200, 300), (200, 0, 400, 300)])
    assert np.abs(line - at).mean() < 8 and np.ptp(line) > 10


def test_seam_is_the_cheapest_line():
    cost = np.random.default_rng(1).random((6, 5))
    import itertools

    best = min((sum(cost[y, x] for y, x in enumerate(p)) + 0.02 * sum(a != b for a, b in itertools.pairwise(p)), p) for p in itertools.product(range(5), repeat=6) if all(abs(a - b) <= 1 for a, b in itertools.pairwise(p)))
    assert S.seam(cost, 0.02).tolist() == list(best[1])


def test_split_shapes():
    x, at = spread()
    a, b = S.split(x, at)
    assert a.shape[0] == b.shape[0] == 300 and a.shape[1] + b.shape[1] in range(395, 420)


def page(tilt=0.0, border=False):
    g = np.full((900, 600), 245.0)
    for y in range(60, 840, 28):
        g[y : y + 4, 60:540] = 35
    m, w, h = K.rotation(600, 900, tilt)
    g = K.warp(g.astype(np.uint8), m, w, h, fill=245).astype(np.float32)
    return np.pad(g, 40, constant_values=10) if border else g


def test_skew():
    assert abs(S.skew(page(6)) + 6) < 1.5
    assert abs(S.skew(page(0, True))) < 3
    assert S.skew(np.full((900, 600), 245, np.float32)) == 0.0


def test_components_and_holes():
    m = np.zeros((100, 100), bool)
    m[20:60, 20:60] = True
    m[30:40, 30:40] = False
    m[80, 80] = True
    assert K.largest(m).sum() == 1500 and K.filled(m).sum() == 1601 and K.keep_components(m, 2).sum() == 1500
    labels, area = K.components(np.eye(5, dtype=bool))
    assert area.tolist() == [0, 5]


def test_quad_holds_the_mask():
    m = np.zeros((200, 300), bool)
    m[50:150, 60:240] = True
    q = K.page_quad(m, 0.02)
    assert q[0, 0] < 60 and q[0, 1] < 50 and q[2, 0] > 239 and q[2, 1] > 149
    assert K.page_quad(np.zeros((20, 30), bool), 0.1).tolist() == [[0, 0], [29, 0], [29, 19], [0, 19]]


def test_quarter_turns_are_rot90():
    x = np.random.default_rng(0).integers(0, 255, (12, 8, 3), dtype=np.uint8)
    for k in range(4):
        m, w, h = K.quarter_turns(8, 12, k)
        assert (K.warp(x, m, w, h, nearest=True) == np.rot90(x, k)).all()


def test_border_and_paper():
    x = np.full((280, 280, 3), 10, np.uint8)
    x[40:-40, 40:-40] = 235
    x[100:104, 60:200] = 20
    assert all(abs(a - b) <= 10 for a, b in zip(S.trim_border(x), (40, 40, 240, 240), strict=True))
    plain = np.full((300, 300, 3), 235, np.uint8)
    assert S.trim_border(plain) == (0, 0, 300, 300) and S.paper_box(plain) is None
    y = np.full((400, 400, 3), 20, np.uint8)
    y[60:-60, 60:-60] = 230
    y[100:300:20, 100:300] = 40
    x0, y0, x1, y1 = S.paper_box(y)
    assert 40 <= x0 <= 100 and 300 <= x1 <= 360 and 40 <= y0 <= 100 and 300 <= y1 <= 360


def test_faint_strokes():
    blank = np.full((300, 300, 3), 235, np.uint8)
    faint = blank.copy()
    faint[150:153, 50:250] = 215
    assert S.content(faint)[1] > S.content(blank)[1]
    assert S.enhanced(faint).astype(float).std() >= faint.astype(float).std()


def test_masks():
    g = np.zeros((1200, 800), np.float32)
    g[100:1100, 150:650] = 210
    band = np.zeros(g.shape, bool)
    band[520:680, 150:650] = True
    assert K.bounds(S.recovered(g, band))[3] - K.bounds(S.recovered(g, band))[1] > 700
    assert not S.recovered(g, np.zeros(g.shape, bool)).any()
    square = np.zeros((1000, 600), bool)
    square[300:700, 100:500] = True
    x0, y0, x1, y1 = K.bounds(S.extended(square, 0.8))
    assert (x1 - x0) / (y1 - y0) <= 0.82
    tall = np.zeros((1000, 600), bool)
    tall[100:900, 100:400] = True
    assert (S.extended(tall, 0.8) == tall).all()
    m = np.ones((200, 220), bool)
    left = S.side_mask(m, np.full(200, 100), True, 0.045, 0.02)
    assert 100 <= K.bounds(left)[2] - 1 <= 108
    assert not S.side_mask(np.zeros((20, 20), bool), np.full(20, 10), True, 0.045, 0.02).any()


def test_padding_and_text_box():
    assert S.padded(np.zeros((300, 100, 3), np.uint8), 2.4).shape[:2] == (300, 125)
    same = np.zeros((280, 200, 3), np.uint8)
    assert S.padded(same, 2.4) is same and S.padded(np.zeros((300, 100, 3), np.uint8), 0).shape == (300, 100, 3)
    assert S.text_box([], 100, 200) is None and S.text_box([(10, 10, 20, 20)], 100, 200) is None
    assert S.text_box([(10, 10, 90, 40), (12, 150, 95, 190)], 100, 200, 0.0) == (10, 10, 95, 190)
    assert S.text_box([(0, 0, 100, 200)], 100, 200, 0.5) == (0, 0, 100, 200)


def facing(left=600, right=260, h=900, seed=1):
    rng = np.random.default_rng(seed)
    x = np.clip(228 + rng.normal(0, 3, (h, left + 10 + right, 3)), 0, 255)
    x[:, left : left + 10] = 40
    for y in range(40, h - 40, 30):
        x[y : y + 6, 30 : left - 40] = 60
        x[y : y + 6, left + 40 : -30] = 60
    return x.astype(np.uint8)


def test_rescue():
    q = np.array([[0, 0], [1, 0], [1, 1], [0, 1.0]])
    at, ratio = S.find_spine(facing())
    assert 590 <= at <= 620 and ratio > 1.5
    r = S.rescue(facing(), q)
    assert r.kept == "left" and 560 <= r.image.shape[1] <= 640 and r.quad[1, 0] < 0.75
    assert S.rescue(facing(260, 600), q).kept == "right"
    assert S.rescue(np.full((900, 600, 3), 225, np.uint8), q).why == "aspect_in_range"
    assert S.rescue(np.full((900, 900, 3), 225, np.uint8), q).why == "too_little_ink"
    assert S.rescue(facing(), q, least_ratio=99).why == "no_confident_spine"


def test_measures():
    g = np.full((200, 200), 255.0, np.float32)
    assert S.white_fraction(g) == 1.0 and S.notch(np.full((90, 90), 200.0)) == 0.0
    ink = g.copy()
    ink[50:60, 50:150] = 0
    assert S.erased_ink(ink, g) == {"share": 1.0, "central": 1.0, "interior": 0.0} and S.erased_ink(g, g)["share"] == 0 and max(S.edge_ink(g).values()) == 0
    assert np.isnan(S.erased_ink(ink, g[:50])["share"])
    prob = np.zeros((200, 200))
    prob[10:40, 10:90], prob[100:150, 10:90] = 1, 1
    assert [b[1] for b in S.entry_boxes(prob)] == [10, 100]
