"""Image kernels on numpy arrays: resizing, masks, components, hashes, and the metrics of a photo."""

from __future__ import annotations

import numpy as np

THUMB = (160, 213)
#: The caption that cameras burn into the top left corner, as shares of height and width.
CAPTION = (0.24, 0.72)
LUMA = (299, 587, 114)


def _lanczos_weights(source: int, target: int) -> np.ndarray:
    """(target, source) weights of a three-lobed Lanczos filter, widened when it shrinks."""
    scale = max(1.0, source / target)
    centre = (np.arange(target) + 0.5) * source / target
    x = (np.arange(source) + 0.5 - centre[:, None]) / scale
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Lanczos resize of (h, w) or (h, w, c), rounded to bytes between the two passes as 8-bit imaging does."""
    byte = lambda a: np.clip(np.floor(a + 0.5), 0, 255)
    rows = byte(np.tensordot(image.astype(np.float64), _lanczos_weights(image.shape[1], width), axes=([1], [1])))
    rows = np.moveaxis(rows, -1, 1)
    out = byte(np.tensordot(_lanczos_weights(image.shape[0], height), rows, axes=([1], [0])))
    return out.astype(np.uint8)


def thumbnail(rgb: np.ndarray, box: tuple[int, int] = THUMB) -> np.ndarray:
    """The image inside the box, aspect kept; never enlarged."""
    h, w = rgb.shape[:2]
    if w <= box[0] and h <= box[1]:
        return rgb
    ratio = min(box[0] / w, box[1] / h)
    return resize(rgb, max(1, round(h * ratio)), max(1, round(w * ratio)))


def luma(rgb: np.ndarray) -> np.ndarray:
    weights = np.array([int(x * 65536 / 1000 + 0.5) for x in LUMA], dtype=np.int64)
    return ((rgb.astype(np.int64) @ weights + 0x8000) >> 16).astype(np.float32)


def edges(grey: np.ndarray) -> np.ndarray:
    """Eight times a pixel less its neighbours, clipped to a byte; border pixels stay as they are."""
    out = grey.astype(np.float64).copy()
    if min(grey.shape) >= 3:
        around = sum(np.roll(np.roll(grey, i, 0), j, 1) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j)
        out[1:-1, 1:-1] = (8 * grey.astype(np.float64) - around)[1:-1, 1:-1]
    return np.clip(out, 0, 255)


def usable(shape: tuple[int, int]) -> np.ndarray:
    out = np.ones(shape, dtype=bool)
    out[: int(CAPTION[0] * shape[0]), : int(CAPTION[1] * shape[1])] = False
    return out


def neighbours(mask: np.ndarray) -> np.ndarray:
    """How many of the eight neighbours of each pixel are set."""
    padded = np.pad(mask.astype(np.int8), 1)
    h, w = mask.shape
    return sum(padded[1 + i : 1 + i + h, 1 + j : 1 + j + w] for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j)


def dilate(mask: np.ndarray, rounds: int = 1) -> np.ndarray:
    for _ in range(rounds):
        mask = mask | (neighbours(mask) > 0)
    return mask


def largest_component(mask: np.ndarray) -> dict[str, int]:
    """Area, box, longer and shorter side of the largest eight-connected component, and whether it touches the frame.

    Runs of a row are joined to the runs of the row above that they meet; of equal
    areas the one whose first pixel comes first in raster order wins.
    """
    h, w = mask.shape
    padded = np.pad(mask.astype(np.int8), ((0, 0), (1, 1)))
    step = np.diff(padded, axis=1)
    row, start = np.nonzero(step == 1)
    _, stop = np.nonzero(step == -1)
    if not len(row):
        return {"area": 0, "w": 0, "h": 0, "long": 0, "short": 0, "touch": 0}
    parent = list(range(len(row)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted(row, np.arange(h + 1))
    for y in range(1, h):
        a, a_end, b, b_end = first[y - 1], first[y], first[y], first[y + 1]
        while a < a_end and b < b_end:
            if start[a] <= stop[b] and start[b] <= stop[a]:
                x, z = root(a), root(b)
                parent[max(x, z)] = min(x, z)
            if stop[a] < stop[b]:
                a += 1
            else:
                b += 1
    roots = np.array([root(i) for i in range(len(row))])
    area = np.bincount(roots, stop - start, minlength=len(row)).astype(np.int64)
    best = int(np.argmax(area))
    own = roots == best
    top, bottom, left, right = row[own].min(), row[own].max(), start[own].min(), stop[own].max() - 1
    cw, ch = int(right - left + 1), int(bottom - top + 1)
    return {"area": int(area[best]), "w": cw, "h": ch, "long": max(cw, ch), "short": min(cw, ch), "touch": int(top == 0 or left == 0 or bottom == h - 1 or right == w - 1)}


def green_mask(rgb: np.ndarray) -> np.ndarray:
    r, g, b = np.moveaxis(rgb.astype(np.int16), 2, 0)
    return (g >= 90) & (g > r + 7) & (g > b + 2)


def metrics(rgb: np.ndarray) -> dict[str, float | int]:
    """The numbers that the first layer decides on, from a decoded photo."""
    small = thumbnail(rgb)
    grey, ok = luma(small), usable(small.shape[:2])
    edge = edges(grey)
    inner = edge[2:-2, 2:-2] if min(edge.shape) > 4 else edge
    r, g, b = np.moveaxis(small.astype(np.int16), 2, 0)
    green = green_mask(small) & ok
    pale = (grey >= 150) & (small.max(axis=2).astype(int) - small.min(axis=2) <= 42) & (edge >= 18) & ok
    candidate = green | pale
    candidate &= neighbours(candidate) >= 2
    comp, own = largest_component(candidate), largest_component(dilate(green, 2))
    seen = grey[ok] if ok.any() else grey.ravel()
    share = lambda m: round(float((m & ok).mean()), 6)
    out: dict[str, float | int] = {
        "mean_luma": round(float(seen.mean()), 3),
        "std_luma": round(float(seen.std()), 3),
        "clip_gelap": round(float((seen <= 8).mean()), 6),
        "clip_terang": round(float((seen >= 247).mean()), 6),
        "edge_mean": round(float(inner.mean()), 3),
        "edge_std": round(float(inner.std()), 3),
        "dark_ratio": share(grey < 85),
        "sky_ratio": share((b > r + 20) & (b >= g) & (b > 100)),
        "vegetasi_ratio": share((g > r + 12) & (g > b + 8) & (grey < 145)),
        "candidate_ratio": share(candidate),
        "chroma_std": round(float((r - g).std() + (g - b).std()), 3),
        "thumb_w": small.shape[1],
        "thumb_h": small.shape[0],
    }
    out |= {f"comp_{k}": v for k, v in comp.items()} | {f"green_{k}": v for k, v in own.items()}
    return out


def green_border(rgb: np.ndarray, band: int = 3) -> dict[str, int]:
    """Green pixels of the frame's border band, and of the side that has most; corners count on both sides."""
    small = thumbnail(rgb)
    green = green_mask(small) & usable(small.shape[:2])
    inside = np.zeros_like(green)
    inside[band:-band, band:-band] = True
    sides = (green[:band], green[-band:], green[:, :band], green[:, -band:])
    return {"green_border_pixels": int((green & ~inside).sum()), "green_border_side_max": int(max(s.sum() for s in sides))}


def _bits_to_hex(bits: np.ndarray) -> str:
    return np.packbits(bits.ravel()).tobytes().hex()


def _dct(n: int) -> np.ndarray:
    k = np.arange(n)
    return 2 * np.cos(np.pi * k[:, None] * (2 * k[None, :] + 1) / (2 * n))


def phash(rgb: np.ndarray) -> str:
    """64 bits: low frequencies of a 32 x 32 cosine transform above their median."""
    grey = resize(luma(rgb), 32, 32).astype(np.float64)
    d = _dct(32)
    low = (d @ grey @ d.T)[:8, :8]
    return _bits_to_hex(low > np.median(low))


def dhash(rgb: np.ndarray) -> str:
    """64 bits: whether a pixel of a 9 x 8 image is darker than the one to its right."""
    grey = resize(luma(rgb), 8, 9).astype(np.int16)
    return _bits_to_hex(grey[:, 1:] > grey[:, :-1])


def shrink(grey: np.ndarray, longest: int) -> np.ndarray:
    """Area-averaged down so that the longest side fits; smaller images stay."""
    h, w = grey.shape
    scale = longest / max(h, w)
    if scale >= 1:
        return grey

    def areas(source: int, target: int) -> np.ndarray:
        edge = np.linspace(0, source, target + 1)
        low, high = np.arange(source)[None, :], np.arange(source)[None, :] + 1
        over = np.clip(np.minimum(high, edge[1:, None]) - np.maximum(low, edge[:-1, None]), 0, None)
        return over / over.sum(axis=1, keepdims=True)

    return areas(h, max(1, round(h * scale))) @ grey.astype(np.float64) @ areas(w, max(1, round(w * scale))).T
