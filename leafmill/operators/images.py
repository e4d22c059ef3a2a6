"""Image transforms on arrays, and their DataFrame forms.

No imaging library is needed: an image is an array of height x width x 3 or
height x width, unsigned bytes, and a codec (bytes to array and back) is given
by the caller; the default is numpy's own file format. Line detection, skew and
smoothing are plain restatements of what they are for, not of a library's
numbers.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..sources.sinks import crop_names


def decode_npy(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


def encode_npy(image: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, image, allow_pickle=False)
    return out.getvalue()


def swap_channels(image: np.ndarray) -> np.ndarray:
    """RGB to BGR and back; an image without channels stays."""
    return image[:, :, ::-1] if image.ndim == 3 else image


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of an RGB image."""
    return image if image.ndim == 2 else np.rint(image[:, :, :3] @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)


def ink(image: np.ndarray, level: int = 150) -> np.ndarray:
    """Where an image is dark."""
    return gray(image) <= level


def crop(image: np.ndarray, roi: tuple[float, float, float, float] | None, padding: float) -> np.ndarray:
    """The region (x1, y1, x2, y2) with padding, black beyond the image. Without a region the image stays whole (Q14)."""
    if roi is None or any(v is None for v in roi):
        return image
    x1, y1, x2, y2 = int(round(roi[0] - padding)), int(round(roi[1] - padding)), int(round(roi[2] + padding)), int(round(roi[3] + padding))
    out = np.zeros((max(0, y2 - y1), max(0, x2 - x1), *image.shape[2:]), image.dtype)
    h, w = image.shape[:2]
    a, b, c, d = max(0, x1), max(0, y1), min(w, x2), min(h, y2)
    if a < c and b < d:
        out[b - y1 : d - y1, a - x1 : c - x1] = image[b:d, a:c]
    return out


def resize(image: np.ndarray, factor: float) -> np.ndarray:
    """Nearest neighbours, where both sides stay above 100 and the factor is not 1."""
    h, w = image.shape[:2]
    if factor == 1 or not (w * factor > 100 and h * factor > 100):
        return image
    rows = np.minimum((np.arange(int(h * factor)) / factor).astype(int), h - 1)
    cols = np.minimum((np.arange(int(w * factor)) / factor).astype(int), w - 1)
    return image[rows][:, cols]


def vertical_lines(image: np.ndarray, length: int = 80) -> list[tuple[int, int, int, int]]:
    """I4: (x1, y1, x2, y2) of runs of ink of at least ``length`` in a column's edges."""
    dark = ink(image)
    edge = dark & ~np.pad(dark, ((0, 0), (1, 0)))[:, :-1]
    out = []
    for x in np.flatnonzero(edge.sum(axis=0) >= length):
        column = np.concatenate([[0], edge[:, x].astype(np.int8), [0]])
        change = np.diff(column)
        out += [(int(x), int(a), int(x), int(b) - 1) for a, b in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1)) if b - a >= length]
    return out


def line_split(lines: list[tuple[int, int, int, int]], width: int, margin: float) -> int | None:
    """The mean of the centres of nearly vertical lines near the middle; None without any."""
    middle = width / 2
    at = []
    for x1, y1, x2, y2 in lines:
        angle = abs(np.degrees(np.arctan2(y2 - y1, x2 - x1)))
        if 70 <= angle <= 90 and middle - middle * margin < (x1 + x2) // 2 < middle + middle * margin:
            at.append((x1 + x2) / 2)
    return int(sum(at) / len(at)) if at else None


def gutter(image: np.ndarray) -> int:
    """Between the first and the last least inked column of the middle fifth."""
    width = image.shape[1]
    lo, hi = int(width * 0.4), int(width * 0.6)
    profile = ink(image)[:, lo:hi].sum(axis=0)
    first, last = int(profile.argmin()), len(profile) - int(profile[::-1].argmin())
    return lo + (first + last) // 2


def split(image: np.ndarray, margin: float = 0.2) -> tuple[np.ndarray, np.ndarray | None]:
    """Halves of a double page, at its middle lines or else at its gutter; a portrait page has one half."""
    height, width = image.shape[:2]
    at = line_split(vertical_lines(image), width, margin)
    if at is None:
        if width < height:
            return image, None
        at = gutter(image)
    return image[:, :at], image[:, at:]


def smooth(image: np.ndarray, size: int, sigma: float | None = None) -> np.ndarray:
    """Gaussian smoothing, edges repeated."""
    sigma = sigma or 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    k = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma * sigma))
    k /= k.sum()
    out = image.astype(float)
    for axis in (0, 1):
        pads = [(size // 2, size // 2) if a == axis else (0, 0) for a in (0, 1)]
        padded = np.pad(out, pads, mode="edge")
        n = out.shape[axis]
        out = sum(w * np.take(padded, range(i, i + n), axis=axis) for i, w in enumerate(k))
    return out


def skew(image: np.ndarray, most: float = 5.0, step: float = 0.5) -> float:
    """The angle, in degrees, under which rows of ink differ most from each other."""
    y, x = np.nonzero(ink(image))
    if not len(y):
        return 0.0
    best, at = -1.0, 0.0
    for angle in sorted(np.arange(-most, most + step, step), key=abs):
        t = np.tan(np.radians(angle))
        rows = np.bincount(np.rint(y - x * t - (y - x * t).min()).astype(int)).astype(float)
        v = float((rows**2).sum())
        if v > best:
            best, at = v, float(angle)
    return at


def rotate(image: np.ndarray, angle: float) -> np.ndarray:
    """Turned about its centre, nearest neighbours, white beyond it."""
    if not angle:
        return image
    h, w = image.shape[:2]
    y, x = np.mgrid[:h, :w]
    c, s = np.cos(np.radians(angle)), np.sin(np.radians(angle))
    u = np.rint(c * (x - w / 2) - s * (y - h / 2) + w / 2).astype(int)
    v = np.rint(s * (x - w / 2) + c * (y - h / 2) + h / 2).astype(int)
    inside = (u >= 0) & (u < w) & (v >= 0) & (v < h)
    out = np.full_like(image, 255)
    out[inside] = image[v[inside], u[inside]]
    return out


def bilateral(image: np.ndarray, size: int = 9, color: float = 75.0, space: float = 75.0) -> np.ndarray:
    """Smoothing that keeps edges."""
    r, own = size // 2, image.astype(float)
    padded = np.pad(own, r, mode="edge")
    total, weight = np.zeros_like(own), np.zeros_like(own)
    for dy in range(-r, r + 1):
        for dx in range(-r, r + 1):
            if dy * dy + dx * dx > r * r:
                continue
            near = padded[r + dy : r + dy + own.shape[0], r + dx : r + dx + own.shape[1]]
            w = np.exp(-(dy * dy + dx * dx) / (2 * space * space) - (near - own) ** 2 / (2 * color * color))
            total += w * near
            weight += w
    return np.rint(total / weight).astype(np.uint8)


def prepare(image: np.ndarray, deskewed: bool = False) -> np.ndarray:
    """Gray, smoothed, thresholded against the surroundings, denoised. The skew is taken out only if asked for."""
    flat = smooth(gray(image), 3)
    if deskewed:
        flat = rotate(flat, skew(np.rint(flat).astype(np.uint8)))
    white = np.where(flat > smooth(flat, 41) - 10, 255, 0).astype(np.uint8)
    return bilateral(white)


@dataclass(frozen=True)
class Cropper:
    """What happens to each page image."""

    padding: float = 100.0
    resize_factor: float = 1.0
    middle_margin: float = 0.2
    double_pages: bool = False
    decode: Callable[[bytes], np.ndarray] = field(default=decode_npy)
    encode: Callable[[np.ndarray], bytes] = field(default=encode_npy)

    def __call__(self, content: bytes, roi: tuple | None = None) -> list[bytes]:
        own = resize(crop(self.decode(content), roi, self.padding), self.resize_factor)
        parts = split(own, self.middle_margin) if self.double_pages else (own,)
        return [self.encode(np.ascontiguousarray(p)) for p in parts if p is not None]


def cropped(images: DataFrame, cropper: Cropper = Cropper()) -> DataFrame:
    """(name, content) of each image's parts. ``images``: name, content, and if there is one ``roi`` (xmin, ymin, xmax, ymax)."""
    columns = ["name", "content", *(["roi"] if "roi" in images.columns else [])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.to_dict("records"):
                roi = row.get("roi")
                roi = None if roi is None else tuple(dict(roi)[k] for k in ("xmin", "ymin", "xmax", "ymax")) if not isinstance(roi, (tuple, list)) else tuple(roi)
                parts = cropper(row["content"], roi)
                yield pd.DataFrame({"name": crop_names(row["name"], len(parts)), "content": parts})

    return images.select(columns).mapInPandas(run, "name string, content binary")


def prepared(images: DataFrame, decode: Callable[[bytes], np.ndarray] = decode_npy, encode: Callable[[np.ndarray], bytes] = encode_npy) -> DataFrame:
    """I8: ``images`` (name, content) made ready for recognition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(content=[encode(prepare(decode(c))) for c in f["content"]])

    return images.select("name", "content").mapInPandas(run, "name string, content binary")
