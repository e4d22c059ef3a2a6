"""Boxes and lines of page layouts, as expressions over named fields x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x1, y1, x2, y2) -> Column:
    return F.struct(*(F.lit(v).cast("double").alias(n) if not isinstance(v, (Column, str)) else (F.col(v) if isinstance(v, str) else v).cast("double").alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), (x1, y1, x2, y2))))


def midpoint(b: Column) -> Column:
    """L1."""
    return F.struct(((b["x1"] + b["x2"]) / 2).alias("x"), ((b["y1"] + b["y2"]) / 2).alias("y"))


def pad(b: Column, share: float = 0.02) -> Column:
    """L2: each side moved outwards by a share of the width or height."""
    w, h = (b["x2"] - b["x1"]) * share, (b["y2"] - b["y1"]) * share
    return F.struct((b["x1"] - w).alias("x1"), (b["y1"] - h).alias("y1"), (b["x2"] + w).alias("x2"), (b["y2"] + h).alias("y2"))


def iou_value(a: Column, b: Column, eps: float = 1e-5) -> Column:
    zero = F.lit(0.0)
    inter = F.greatest(zero, F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])) * F.greatest(zero, F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    area = (a["x2"] - a["x1"]) * (a["y2"] - a["y1"]) + (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])
    return inter / (area - inter + eps)


def iou(a: Column, b: Column, threshold: float = 0.0, eps: float = 1e-5) -> Column:
    """Whether the overlap is above the threshold."""
    return iou_value(a, b, eps) > threshold


def merge_boxes(a: Column, b: Column) -> Column:
    """L4."""
    return F.struct(F.least(a["x1"], b["x1"]).alias("x1"), F.least(a["y1"], b["y1"]).alias("y1"), F.greatest(a["x2"], b["x2"]).alias("x2"), F.greatest(a["y2"], b["y2"]).alias("y2"))


def box_area(w: Column, h: Column) -> Column:
    """L11."""
    return w * h


def large_enough(w: Column, h: Column, page_area: Column, share: float) -> Column:
    """P3."""
    return w * h >= page_area * share


def middle_line(x1: Column, y1: Column, x2: Column, y2: Column, middle: Column, margin: float) -> Column:
    """Nearly vertical, and near the page's middle."""
    angle = F.abs(F.degrees(F.atan2(y2 - y1, x2 - x1)))
    at = F.floor((x1 + x2) / 2)
    return angle.between(70, 90) & (at > middle - middle * margin) & (at < middle + middle * margin)


def is_portrait(w: Column, h: Column) -> Column:
    """Such a page is not split."""
    return w < h


def resizes(w: Column, h: Column, factor: float) -> Column:
    """Both sides stay above 100 pixels, and the factor is not 1."""
    return (w * factor > 100) & (h * factor > 100) & (F.lit(float(factor)) != 1.0)
