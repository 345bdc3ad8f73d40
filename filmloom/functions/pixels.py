"""Image measures on grey or colour pixel arrays, batch by batch.

Frames arrive as a binary column of raw 8-bit values with their height and
width; decoding files is left to a media library outside.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MEASURES = "brightness double, contrast double, sharpness double, text_ratio double, saturation double, local_contrast double, black_rows int"


def laplacian_variance(grey: np.ndarray) -> float:
    """Variance of the four-neighbour Laplacian."""
    g = grey.astype(np.float64)
    if min(g.shape) < 3:
        return 0.0
    inner = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    return float(inner.var())


def grid_sharpness(grey: np.ndarray, tiles: int = 7, background: float = 0.5) -> float:
    """Greatest Laplacian variance of the tiles; those on the border count half."""
    rows, cols = (np.array_split(np.arange(n), tiles) for n in grey.shape)
    best = 0.0
    for i, r in enumerate(rows):
        for j, c in enumerate(cols):
            if len(r) > 2 and len(c) > 2:
                weight = 1.0 if 0 < i < tiles - 1 and 0 < j < tiles - 1 else background
                best = max(best, weight * laplacian_variance(grey[r[0] : r[-1] + 1, c[0] : c[-1] + 1]))
    return best


def local_contrast(grey: np.ndarray, patch: int = 64) -> float:
    """Median standard deviation of square patches."""
    h, w = (max(patch, n) for n in grey.shape)
    stds = [grey[y : y + patch, x : x + patch].std() for y in range(0, h - patch + 1, patch) for x in range(0, w - patch + 1, patch)]
    return float(np.median(stds))


def text_ratio(grey: np.ndarray, change: int = 60, least: float = 0.08) -> float:
    """Share of rows with many strong changes from pixel to pixel, as in lines of text."""
    strong = np.abs(np.diff(grey.astype(np.int16), axis=1)) > change
    return float((strong.mean(axis=1) > least).mean()) if strong.size else 0.0


def saturation(rgb: np.ndarray) -> float:
    """Mean saturation on a scale to 255."""
    high, low = rgb.max(axis=2).astype(float), rgb.min(axis=2).astype(float)
    return float(np.divide(255 * (high - low), high, out=np.zeros_like(high), where=high > 0).mean())


def dark_rows(grey: np.ndarray, above: float = 10.0) -> int:
    """Dark rows at the top and bottom that can be cut off."""
    lit = np.flatnonzero(grey.mean(axis=1) > above)
    return int(grey.shape[0] if not len(lit) else lit[0] + grey.shape[0] - 1 - lit[-1])


def letterbox(grey: np.ndarray, above: float = 15.0, most: float = 1 / 3, least: int = 20) -> tuple[int, int]:
    """First and past-the-end row without letterbox bars; bars of up to ``least`` rows, or over a third of the height, stay."""
    lit = np.flatnonzero(grey.mean(axis=1) > above)
    h = grey.shape[0]
    if not len(lit):
        return 0, h
    top, bottom = int(lit[0]), int(h - 1 - lit[-1])
    ok = lambda n: least < n <= h * most
    return (top if ok(top) else 0), h - (bottom if ok(bottom) else 0)


def stable_template(patches: np.ndarray, scale: float = 40.0) -> tuple[float, np.ndarray]:
    """Stability from 0 to 1 and the median of equal patches of several frames: an overlay hardly changes."""
    stack = patches.astype(np.float32)
    return 1.0 - min(1.0, float(stack.std(axis=0).mean()) / scale), np.median(stack, axis=0)


def measure(grey: np.ndarray, rgb: np.ndarray | None) -> tuple:
    return (float(grey.mean()), float(grey.std()), grid_sharpness(grey), text_ratio(grey), saturation(rgb) if rgb is not None else 0.0, local_contrast(grey), dark_rows(grey))


def _frames(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    rows = []
    for p, h, w in zip(pixels, height, width, strict=True):
        n = 0 if p is None else len(p)
        if not n or not h or not w or n not in (h * w, 3 * h * w):
            rows.append((None,) * 7)
            continue
        a = np.frombuffer(p, np.uint8)
        rgb = a.reshape(int(h), int(w), 3) if n == 3 * h * w else None
        grey = a.reshape(int(h), int(w)) if rgb is None else (rgb @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)
        rows.append(measure(grey, rgb))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in MEASURES.split(", ")]).astype({"black_rows": "Int32"})


def image_measures(pixels: Column, height: Column, width: Column) -> Column:
    """Struct of measures of each frame (grey if it has one value per pixel, else RGB); null members where the size doesn't fit."""
    return F.pandas_udf(_frames, MEASURES)(pixels, height, width)
