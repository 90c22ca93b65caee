"""Local features of photos: a deterministic corner detector with binary descriptors, matching, and a homography check.

Any extractor of (points, descriptors) may be plugged in; matching and the score
depend on those alone.  Descriptors are made once for each photo and joined to its pairs.
"""

from __future__ import annotations

import numpy as np

from lensgraph.config import LocalFeatures

BITS = 256
PATCH = 15
_TESTS = np.random.default_rng(256).integers(-PATCH, PATCH + 1, (BITS, 4))


def extract(grey: np.ndarray, cfg: LocalFeatures = LocalFeatures()) -> tuple[np.ndarray, np.ndarray]:
    """((n, 2) x, y points, (n, 32) packed descriptors) of the strongest corners away from the border."""
    g = grey.astype(np.float64)
    if min(g.shape) <= 2 * PATCH + 2:
        return np.zeros((0, 2)), np.zeros((0, BITS // 8), dtype=np.uint8)
    gy, gx = np.gradient(g)

    def box(a: np.ndarray, r: int = 2) -> np.ndarray:
        s = np.pad(np.cumsum(np.cumsum(np.pad(a, r), 0), 1), ((1, 0), (1, 0)))
        k = 2 * r + 1
        return s[k:, k:] - s[:-k, k:] - s[k:, :-k] + s[:-k, :-k]

    xx, yy, xy = box(gx * gx), box(gy * gy), box(gx * gy)
    strength = xx * yy - xy * xy - 0.04 * (xx + yy) ** 2
    peak = np.ones_like(strength, dtype=bool)
    for i in (-1, 0, 1):
        for j in (-1, 0, 1):
            if i or j:
                peak &= strength >= np.roll(np.roll(strength, i, 0), j, 1)
    inside = np.zeros_like(peak)
    inside[PATCH + 1 : -PATCH - 1, PATCH + 1 : -PATCH - 1] = True
    y, x = np.nonzero(peak & inside & (strength > 1e-6))
    order = np.argsort(-strength[y, x], kind="stable")[: cfg.nfeatures]
    y, x = y[order], x[order]
    smooth = box(g)
    bits = smooth[y[:, None] + _TESTS[:, 0], x[:, None] + _TESTS[:, 1]] < smooth[y[:, None] + _TESTS[:, 2], x[:, None] + _TESTS[:, 3]]
    return np.stack((x, y), axis=1).astype(np.float64), np.packbits(bits, axis=1)


def match(a: np.ndarray, b: np.ndarray, ratio: float) -> tuple[int, np.ndarray]:
    """(matches tried, (k, 2) index pairs): the nearest by Hamming distance, where it beats the second nearest by the ratio."""
    if not len(a) or not len(b):
        return 0, np.zeros((0, 2), dtype=np.int64)
    distance = np.bitwise_count(a[:, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.int64)
    if len(b) < 2:
        return len(a), np.zeros((0, 2), dtype=np.int64)
    order = np.argsort(distance, axis=1, kind="stable")[:, :2]
    first, second = np.take_along_axis(distance, order, 1).T
    good = first < ratio * second
    return len(a), np.stack((np.flatnonzero(good), order[good, 0]), axis=1)


def _homography(p: np.ndarray, q: np.ndarray) -> np.ndarray | None:
    """Direct linear transform from p to q, on normalised points."""

    def norm(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centre, spread = x.mean(0), max(x.std(), 1e-9)
        t = np.array([[1 / spread, 0, -centre[0] / spread], [0, 1 / spread, -centre[1] / spread], [0, 0, 1]])
        return (x - centre) / spread, t

    (a, ta), (b, tb) = norm(p), norm(q)
    rows = []
    for (x, y), (u, v) in zip(a, b, strict=True):
        rows += [[-x, -y, -1, 0, 0, 0, u * x, u * y, u], [0, 0, 0, -x, -y, -1, v * x, v * y, v]]
    _, s, vt = np.linalg.svd(np.array(rows))
    if s[-2] < 1e-9:
        return None
    return np.linalg.inv(tb) @ vt[-1].reshape(3, 3) @ ta


def inliers(p: np.ndarray, q: np.ndarray, threshold: float, rounds: int = 500, seed: int = 7) -> int:
    """Most points that one homography maps within the threshold, by seeded random samples of four."""
    rng, best = np.random.default_rng(seed), 0
    for _ in range(rounds):
        pick = rng.choice(len(p), 4, replace=False)
        h = _homography(p[pick], q[pick])
        if h is None:
            continue
        mapped = np.c_[p, np.ones(len(p))] @ h.T
        with np.errstate(divide="ignore", invalid="ignore"):
            error = np.hypot(*(mapped[:, :2] / mapped[:, 2:] - q).T)
        best = max(best, int((error <= threshold).sum()))
        if best == len(p):
            break
    return best


def compare(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], cfg: LocalFeatures = LocalFeatures()) -> dict[str, int | float]:
    """The verification columns of one pair."""
    tried, pairs = match(a[1], b[1], cfg.ratio_test)
    consistent = inliers(a[0][pairs[:, 0]], b[0][pairs[:, 1]], cfg.ransac_reproj_threshold) if len(pairs) >= cfg.min_good_matches else 0
    score = round(min(1.0, consistent / max(1, min(len(a[0]), len(b[0])))), 6)
    return {"keypoints_image_a": len(a[0]), "keypoints_image_b": len(b[0]), "total_matches": tried, "good_matches": len(pairs), "geometrically_consistent_matches": consistent, "feature_match_score": score}
