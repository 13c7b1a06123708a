"""Image kernels in NumPy: filters, thresholds, morphology, components, warps. Images are BGR uint8 or gray arrays."""

from __future__ import annotations

import numpy as np


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of a BGR image as float32; gray images as they are."""
    if image.ndim == 2:
        return image.astype(np.float32)
    return (image @ np.array([0.114, 0.587, 0.299], np.float32)).astype(np.float32)


_LINEAR = np.arange(256) / 255.0
_LINEAR = np.where(_LINEAR <= 0.04045, _LINEAR / 12.92, ((_LINEAR + 0.055) / 1.055) ** 2.4).astype(np.float32)
# sRGB primaries and white (D65) as XYZ shares of white, columns for B, G, R.
_XYZ = np.array([[0.189828, 0.376219, 0.433953], [0.072169, 0.715160, 0.212671], [0.872766, 0.109477, 0.017758]], np.float32)


def _cube(t: np.ndarray) -> np.ndarray:
    return np.where(t > 0.008856, np.cbrt(t), 7.787 * t + 16 / 116)


def lab(image: np.ndarray) -> np.ndarray:
    """CIE L*a*b* of a BGR image with all three scaled to 0..255 (a and b about 128), as float32."""
    f = _cube(_LINEAR[image] @ _XYZ.T)
    l = 116 * f[..., 1] - 16
    return np.stack([l * 2.55, 500 * (f[..., 0] - f[..., 1]) + 128, 200 * (f[..., 1] - f[..., 2]) + 128], axis=-1).astype(np.float32)


def from_lab(x: np.ndarray) -> np.ndarray:
    """The BGR image of L*a*b* values as :func:`lab` has them."""
    fy = (x[..., 0] / 2.55 + 16) / 116
    f = np.stack([fy + (x[..., 1] - 128) / 500, fy, fy - (x[..., 2] - 128) / 200], axis=-1)
    t = np.where(f > 0.206893, f**3, (f - 16 / 116) / 7.787)
    v = np.clip(t @ np.linalg.inv(_XYZ).T, 0, 1)
    v = np.where(v <= 0.0031308, 12.92 * v, 1.055 * v ** (1 / 2.4) - 0.055)
    return np.clip(np.round(v * 255), 0, 255).astype(np.uint8)


# ---------------------------------------------------------------- filters
def convolve(x: np.ndarray, weights: np.ndarray, axis: int, mode: str = "reflect") -> np.ndarray:
    """Correlation along one axis; the border is mirrored without repeating the edge, or ``mode`` as numpy.pad has it."""
    half = len(weights) // 2
    if half >= x.shape[axis]:
        mode = "edge"
    pad = [(0, 0)] * x.ndim
    pad[axis] = (half, len(weights) - 1 - half)
    padded = np.pad(x.astype(np.float32), pad, mode)
    n = x.shape[axis]
    out = np.zeros(x.shape, np.float32)
    for i, w in enumerate(weights):
        out += np.float32(w) * np.take(padded, range(i, i + n), axis) if x.ndim > 2 else np.float32(w) * (padded[i : i + n] if axis == 0 else padded[:, i : i + n])
    return out


def gaussian_weights(sigma: float) -> np.ndarray:
    half = max(1, int(np.ceil(3 * sigma)))
    x = np.arange(-half, half + 1)
    w = np.exp(-(x * x) / (2 * sigma * sigma))
    return w / w.sum()


def smooth(profile: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing of a profile, mirrored at its ends."""
    w = gaussian_weights(max(sigma, 1e-3))
    half = len(w) // 2
    return np.convolve(np.pad(profile.astype(float), half, "reflect" if half < len(profile) else "edge"), w, "valid")


def blur(x: np.ndarray, sigma: float) -> np.ndarray:
    w = gaussian_weights(sigma)
    return convolve(convolve(x, w, 0), w, 1)


def _windows(x: np.ndarray, h: int, w: int, mode: str) -> np.ndarray:
    """Sums over h x w boxes from an integral image."""
    p = np.pad(x.astype(np.float64), ((h // 2, h - 1 - h // 2), (w // 2, w - 1 - w // 2)), mode)
    s = np.pad(p.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return s[h:, w:] - s[:-h, w:] - s[h:, :-w] + s[:-h, :-w]


def box(x: np.ndarray, h: int, w: int, mode: str = "edge") -> np.ndarray:
    return _windows(x, h, w, mode) / (h * w)


def local_stats(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation in a box around every pixel."""
    mean = box(x, size, size)
    return mean, np.sqrt(np.maximum(box(x.astype(np.float64) ** 2, size, size) - mean**2, 0))


def sobel(x: np.ndarray) -> np.ndarray:
    ramp, hat = np.array([-1, 0, 1]), np.array([1, 2, 1])
    return np.hypot(convolve(convolve(x, ramp, 1), hat, 0), convolve(convolve(x, ramp, 0), hat, 1))


def canny(g: np.ndarray, low: float, high: float) -> np.ndarray:
    """Thin edges: crests of the gradient (sum of both magnitudes) above ``low`` that hang together with one above ``high``."""
    ramp, hat = np.array([-1, 0, 1]), np.array([1, 2, 1])
    gx, gy = convolve(convolve(g, ramp, 1, "edge"), hat, 0, "edge"), convolve(convolve(g, ramp, 0, "edge"), hat, 1, "edge")
    ax, ay = np.abs(gx), np.abs(gy)
    m = ax + ay
    around = np.pad(m, 1)
    near = lambda dy, dx: around[1 + dy : 1 + dy + m.shape[0], 1 + dx : 1 + dx + m.shape[1]]
    flat, steep, falling = ay <= np.tan(np.pi / 8) * ax, ax <= np.tan(np.pi / 8) * ay, gx * gy > 0
    crest = np.where(
        flat, (m > near(0, -1)) & (m >= near(0, 1)),
        np.where(steep, (m > near(-1, 0)) & (m >= near(1, 0)), np.where(falling, (m > near(-1, -1)) & (m > near(1, 1)), (m > near(-1, 1)) & (m > near(1, -1)))),
    )
    labels, area = components(crest & (m > low))
    sure = np.zeros(len(area), bool)
    sure[np.unique(labels[crest & (m > high)])] = True
    sure[0] = False
    return sure[labels]


def median(x: np.ndarray, size: int) -> np.ndarray:
    """The median of a size x size box around every pixel of an 8-bit image (edge repeated).

    A pixel's median is the least value that more than half of its box does not exceed: first its sixteenth of the
    scale is found, then the value in those sixteenths that some pixel needs."""
    v = np.clip(np.round(x), 0, 255).astype(np.uint8)
    half = size * size / 2
    coarse = np.full(v.shape, 15, np.uint8)
    for c in range(14, -1, -1):
        coarse[_windows(v <= 16 * c + 15, size, size, "edge") > half] = c
    out = np.zeros(v.shape, np.uint8)
    for c in np.unique(coarse).tolist():
        own = coarse == c
        best = np.full(v.shape, 16 * c + 15, np.uint8)
        for t in range(16 * c + 14, 16 * c - 1, -1):
            best[_windows(v <= t, size, size, "edge") > half] = t
        out[own] = best[own]
    return out


def normalise(x: np.ndarray) -> np.ndarray:
    low, high = float(x.min()), float(x.max())
    return np.zeros(x.shape, np.float32) if high - low < 1e-6 else ((x - low) / (high - low)).astype(np.float32)


def otsu(x: np.ndarray) -> int:
    """The threshold t with the greatest variance between x <= t and x > t, the least of equals."""
    n = np.bincount(np.clip(x, 0, 255).astype(np.uint8).ravel(), minlength=256).astype(float)
    w, m = n.cumsum(), (n * np.arange(256)).cumsum()
    rest = w[-1] - w
    ok = (w > 0) & (rest > 0)
    gap = m * w[-1] - m[-1] * w
    v = np.where(ok, gap * gap / np.where(ok, w * rest, 1), 0)
    return int(v.argmax())


def equalise(x: np.ndarray, clip: float = 3.0, tiles: int = 8) -> np.ndarray:
    """Contrast-limited adaptive histogram equalisation, blended between tiles."""
    h, w = x.shape
    ys, xs = np.linspace(0, h, tiles + 1).astype(int), np.linspace(0, w, tiles + 1).astype(int)
    maps = np.zeros((tiles, tiles, 256), np.float32)
    for i in range(tiles):
        for j in range(tiles):
            part = x[ys[i] : max(ys[i + 1], ys[i] + 1), xs[j] : max(xs[j + 1], xs[j] + 1)]
            n = np.bincount(part.astype(np.uint8).ravel(), minlength=256).astype(float)
            most = max(1.0, clip * n.sum() / 256)
            n = np.minimum(n, most) + np.maximum(n - most, 0).sum() / 256
            maps[i, j] = n.cumsum() / n.sum() * 255
    fy = np.clip((np.arange(h) + 0.5) * tiles / h - 0.5, 0, tiles - 1)
    fx = np.clip((np.arange(w) + 0.5) * tiles / w - 0.5, 0, tiles - 1)
    y0, x0 = np.floor(fy).astype(int), np.floor(fx).astype(int)
    y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
    ty, tx = (fy - y0)[:, None], (fx - x0)[None, :]
    v = x.astype(np.uint8)
    at = lambda a, b: maps[a[:, None], b[None, :], v]
    return ((at(y0, x0) * (1 - tx) + at(y0, x1) * tx) * (1 - ty) + (at(y1, x0) * (1 - tx) + at(y1, x1) * tx) * ty).astype(np.uint8)


# ---------------------------------------------------------------- morphology
def dilate(mask: np.ndarray, h: int, w: int | None = None) -> np.ndarray:
    return _windows(mask > 0, h, w or h, "constant") > 0.5


def erode(mask: np.ndarray, h: int, w: int | None = None) -> np.ndarray:
    return ~dilate(~(mask > 0), h, w)


def opened(mask: np.ndarray, k: int) -> np.ndarray:
    return dilate(erode(mask, k), k)


def closed(mask: np.ndarray, k: int) -> np.ndarray:
    return erode(dilate(mask, k), k)


def cross_opened(mask: np.ndarray) -> np.ndarray:
    """An opening by a pixel and its four neighbours: what no cross fits into goes."""
    grown = lambda m, op, edge: op.reduce([m, *(np.pad(m, 1, constant_values=edge)[1 + y : 1 + y + m.shape[0], 1 + x : 1 + x + m.shape[1]] for y, x in ((-1, 0), (1, 0), (0, -1), (0, 1)))])
    return grown(grown(mask, np.logical_and, True), np.logical_or, False)


def running(x: np.ndarray, k: int, best: np.ufunc, axis: int) -> np.ndarray:
    """The best of k neighbours along an axis (edge repeated), from those of 1, 2, 4 ... neighbours."""
    p = np.pad(x, [(k // 2, k - 1 - k // 2) if a == axis else (0, 0) for a in (0, 1)], "edge")
    cut = (lambda v, a, b: v[a:b]) if axis == 0 else (lambda v, a, b: v[:, a:b])
    width = 1
    while 2 * width <= k:
        n = p.shape[axis] - width
        p = best(cut(p, 0, n), cut(p, width, width + n))
        width *= 2
    if rest := k - width:
        n = p.shape[axis] - rest
        p = best(cut(p, 0, n), cut(p, rest, rest + n))
    return p


def gray_close(x: np.ndarray, k: int) -> np.ndarray:
    """Gray closing: the greatest value in a box, then the least."""
    for best in (np.maximum, np.minimum):
        x = running(running(x, k, best, 0), k, best, 1)
    return x


# ---------------------------------------------------------------- components
def components(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels (0 outside, 8-neighbours together) and the area of each label; from runs in rows, joined by their least neighbour."""
    m = np.asarray(mask, bool)
    h, w = m.shape
    edge = np.diff(np.pad(m.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    n = len(row)
    labels = np.zeros((h, w), np.int32)
    if not n:
        return labels, np.zeros(1, np.int64)
    span = w + 2
    # runs of the row above that touch: ends after my start, starts before my end
    first = np.searchsorted(row * span + end, (row - 1) * span + start, "left")
    last = np.searchsorted(row * span + start, (row - 1) * span + end, "right")
    count = np.maximum(last - first, 0)
    a = np.repeat(np.arange(n), count)
    b = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    _, ids = np.unique(root, return_inverse=True)
    paint = np.zeros((h, w + 1), np.int64)
    np.add.at(paint, (row, start), ids + 1)
    np.add.at(paint, (row, end), -(ids + 1))
    labels = paint.cumsum(1)[:, :w].astype(np.int32)
    area = np.bincount(ids, end - start, ids.max() + 1).astype(np.int64)
    return labels, np.r_[0, area]


def keep_components(mask: np.ndarray, least: float = 0, most: int | None = None) -> np.ndarray:
    """The components of at least so many pixels, the ``most`` largest of them; by one lookup of all labels."""
    labels, area = components(mask)
    chosen = area >= max(least, 1)
    chosen[0] = False
    if most is not None and chosen.sum() > most:
        order = np.argsort(-np.where(chosen, area, 0), kind="stable")[:most]
        chosen = np.isin(np.arange(len(area)), order) & chosen
    return chosen[labels]


def largest(mask: np.ndarray) -> np.ndarray:
    return keep_components(mask, most=1)


def filled(mask: np.ndarray) -> np.ndarray:
    """The mask with its holes: what outside does not reach the border."""
    m = np.pad(mask > 0, 1)
    labels, _ = components(~m)
    return (labels != labels[0, 0])[1:-1, 1:-1]


def bounds(mask: np.ndarray) -> tuple[int, int, int, int] | None:
    """x0, y0, x1, y1 (exclusive) of a mask."""
    ys, xs = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    return (int(xs[0]), int(ys[0]), int(xs[-1]) + 1, int(ys[-1]) + 1) if len(xs) else None


# ---------------------------------------------------------------- geometry
def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def half(seq):
        out: list = []
        for q in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]
    p = p.tolist()
    return np.array(half(p) + half(p[::-1]), float)


def outline(mask: np.ndarray) -> np.ndarray:
    """The first and last pixel of each row of a mask, as corner points."""
    ys = np.flatnonzero(mask.any(1))
    x0 = mask[ys].argmax(1)
    x1 = mask.shape[1] - mask[ys, ::-1].argmax(1) - 1
    return np.concatenate([np.stack([x0, ys], 1), np.stack([x1, ys], 1)]).astype(float)


def order_quad(q: np.ndarray) -> np.ndarray:
    s, d = q.sum(1), q[:, 1] - q[:, 0]
    return q[[s.argmin(), d.argmin(), s.argmax(), d.argmax()]]


def page_quad(mask: np.ndarray, margin: float) -> np.ndarray:
    """The least-area rectangle around the largest part of a mask, grown by a share of its diagonal; an empty mask is the whole frame."""
    h, w = mask.shape
    if not mask.any():
        return np.array([[0, 0], [w - 1, 0], [w - 1, h - 1], [0, h - 1]], float)
    points = hull(outline(largest(mask)))
    edges = np.diff(np.r_[points, points[:1]], axis=0)
    angles = np.unique(np.round(np.arctan2(edges[:, 1], edges[:, 0]) % (np.pi / 2), 9)) if len(points) > 2 else np.zeros(1)
    best = None
    for t in angles:
        axes = np.array([[np.cos(t), np.sin(t)], [-np.sin(t), np.cos(t)]])
        p = points @ axes.T
        low, high = p.min(0), p.max(0)
        area = float(np.prod(high - low))
        if best is None or area < best[0] - 1e-9:
            best = (area, axes, low, high)
    _, axes, low, high = best
    grow = margin * float(np.hypot(*(high - low)))
    low, high = low - grow, high + grow
    corners = np.array([[low[0], low[1]], [high[0], low[1]], [high[0], high[1]], [low[0], high[1]]]) @ axes
    return order_quad(corners)


def homography(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The 3 x 3 matrix that carries four points to four others."""
    rows = []
    for (x, y), (u, v) in zip(source, target, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
    return np.append(np.linalg.solve(np.array(rows, float), target.astype(float).ravel()), 1).reshape(3, 3)


def quad_homography(quad: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The matrix that straightens a quad, and the width and height of the result."""
    side = lambda a, b: float(np.hypot(*(quad[a] - quad[b])))
    w, h = (max(2, round(max(side(a, b), side(c, d))) + 1) for a, b, c, d in ((0, 1, 3, 2), (0, 3, 1, 2)))
    return homography(quad, np.array([[0, 0], [w - 1, 0], [w - 1, h - 1], [0, h - 1]])), w, h


def rotation(w: int, h: int, degrees: float) -> tuple[np.ndarray, int, int]:
    """A counter-clockwise rotation about the middle whose frame holds the whole image."""
    t = np.deg2rad(degrees)
    c, s = np.cos(t), np.sin(t)
    nw, nh = (max(1, round(x)) for x in (h * abs(s) + w * abs(c), h * abs(c) + w * abs(s)))
    move = lambda x, y: np.array([[1, 0, x], [0, 1, y], [0, 0, 1.0]])
    return move((nw - 1) / 2, (nh - 1) / 2) @ np.array([[c, s, 0], [-s, c, 0], [0, 0, 1.0]]) @ move(-(w - 1) / 2, -(h - 1) / 2), nw, nh


def quarter_turns(w: int, h: int, k: int) -> tuple[np.ndarray, int, int]:
    """k counter-clockwise quarter turns, pixel for pixel."""
    return {0: (np.eye(3), w, h), 1: (np.array([[0, 1, 0], [-1, 0, w - 1], [0, 0, 1.0]]), h, w), 2: (np.array([[-1, 0, w - 1], [0, -1, h - 1], [0, 0, 1.0]]), w, h), 3: (np.array([[0, -1, h - 1], [1, 0, 0], [0, 0, 1.0]]), h, w)}[k % 4]


def _cubic(t: np.ndarray) -> list[np.ndarray]:
    """Weights of the four neighbours at distances 1 + t, t, 1 - t and 2 - t (cubic convolution with a = -0.75)."""
    a = np.float32(-0.75)
    near = lambda d: ((a + 2) * d - (a + 3)) * d * d + 1
    far = lambda d: ((a * d - 5 * a) * d + 8 * a) * d - 4 * a
    return [far(1 + t), near(t), near(1 - t), far(2 - t)]


def warp(image: np.ndarray, matrix: np.ndarray, w: int, h: int, nearest: bool = False, fill: float | None = None) -> np.ndarray:
    """The image under a matrix, once, by looking every target pixel up (bicubic); beyond the edge the edge, or ``fill``."""
    back = np.linalg.inv(matrix)
    ih, iw = image.shape[:2]
    # one plane for each channel: numbers are looked up faster than rows of them
    planes = [np.ascontiguousarray(p).ravel() for p in np.moveaxis(image.reshape(ih, iw, -1), 2, 0)]
    out = np.empty((h, w, len(planes)), image.dtype)
    x = np.arange(w, dtype=np.float64)
    for top in range(0, h, 64):  # strips stay in the processor's cache
        y = np.arange(top, min(h, top + 64), dtype=np.float64)[:, None]
        z = back[2, 0] * x + back[2, 1] * y + back[2, 2]
        sx, sy = (back[0, 0] * x + back[0, 1] * y + back[0, 2]) / z, (back[1, 0] * x + back[1, 1] * y + back[1, 2]) / z
        outside = (sx < -0.5) | (sy < -0.5) | (sx > iw - 0.5) | (sy > ih - 0.5) if fill is not None else None
        sx, sy = np.clip(sx, 0, iw - 1), np.clip(sy, 0, ih - 1)
        ix, iy = np.floor(sx).astype(np.int32), np.floor(sy).astype(np.int32)
        fx, fy = (sx - ix).astype(np.float32), (sy - iy).astype(np.float32)
        strip = out[top : top + len(y)]
        if nearest or not (fx.any() or fy.any()):
            at = np.round(sy).astype(np.int32) * iw + np.round(sx).astype(np.int32)
            for c, plane in enumerate(planes):
                strip[..., c] = plane.take(at)
        else:
            columns = [np.clip(ix + i, 0, iw - 1) for i in (-1, 0, 1, 2)]
            sums = [np.zeros((len(y), w), np.float32) for _ in planes]
            wx = _cubic(fx)
            for j, wy in zip((-1, 0, 1, 2), _cubic(fy), strict=True):
                row = np.clip(iy + j, 0, ih - 1) * iw
                for wide, column in zip(wx, columns, strict=True):
                    weight, at = wide * wy, row + column
                    for total, plane in zip(sums, planes, strict=True):
                        total += weight * plane.take(at)
            for c, total in enumerate(sums):
                strip[..., c] = np.clip(np.round(total), 0, 255) if image.dtype == np.uint8 else total
        if outside is not None:
            strip[outside] = fill
    return out.reshape(h, w, *image.shape[2:])


def shrunk(image: np.ndarray, longest: int) -> np.ndarray:
    """The image with its long side at ``longest`` at most, by area means."""
    step = -(-max(image.shape[:2]) // longest)
    if step <= 1:
        return image
    h, w = (s // step * step for s in image.shape[:2])
    if not h or not w:
        return image
    kind = np.uint32 if image.dtype.kind in "bu" else np.float32
    total = np.zeros((h // step, w // step, *image.shape[2:]), kind)
    for y in range(step):
        for x in range(step):
            total += image[y:h:step, x:w:step]
    return (total / (step * step)).astype(image.dtype)


def resized(image: np.ndarray, w: int, h: int) -> np.ndarray:
    """The image at another size: area means by whole steps first where it shrinks, then bilinear."""
    step = min(image.shape[0] // h, image.shape[1] // w)
    if step > 1:
        image = shrunk(image, -(-max(image.shape[:2]) // step))
    ih, iw = image.shape[:2]
    parts = []
    for n, m in ((ih, h), (iw, w)):
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        parts.append((low, np.minimum(low + 1, n - 1), (at - low).astype(np.float32)))
    (y0, y1, fy), (x0, x1, fx) = parts
    more = (1,) * (image.ndim - 2)
    fy, fx = fy.reshape(-1, 1, *more), fx.reshape(1, -1, *more)
    v = image.astype(np.float32)
    rows = v[y0] * (1 - fy) + v[y1] * fy
    out = rows[:, x0] * (1 - fx) + rows[:, x1] * fx
    return np.clip(np.round(out), 0, 255).astype(np.uint8) if image.dtype == np.uint8 else out
