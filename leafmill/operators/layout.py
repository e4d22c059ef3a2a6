"""Layout: columns from text boxes, regions of interest, split lines, natural order."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import predicates as P
from .chunk import numbered_items

BOX = "struct<x1:double,y1:double,x2:double,y2:double>"


def merge_columns(boxes: Column) -> Column:
    """Boxes sorted by x1 (stable), each merged into the last kept box that it overlaps. ``boxes``: array of x1, y1, x2, y2."""
    ordered = F.transform(
        F.array_sort(F.transform(boxes, lambda b, i: F.struct(b["x1"].alias("k"), i.alias("i"), b.alias("b")))),
        lambda s: s["b"],
    )

    def step(a: Column, b: Column) -> Column:
        last = F.element_at(a, -1)
        head = F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))
        joined = F.concat(head, F.array(G.merge_boxes(last, b)))
        return F.when(F.size(a) == 0, F.array(b)).when(G.iou(last, b), joined).otherwise(F.array_append(a, b))

    return F.aggregate(ordered, F.array().cast(f"array<{BOX}>"), step)


def boxes_and_midpoints(boxes: DataFrame, text: str = "text", box: str = "box") -> DataFrame:
    """Boxes with text, and their midpoints."""
    return boxes.where(P.not_empty(F.col(text))).withColumn("mid", G.midpoint(F.col(box)))


def gap_groups(boxes: DataFrame, page: str, x: str, gap: float) -> DataFrame:
    """L7 without Python, approximate: boxes of a page whose midpoints follow each other within ``gap`` are a group (``label`` from 0)."""
    w = Window.partitionBy(page).orderBy(x)
    jump = (F.col(x) - F.lag(x).over(w) > gap).cast("int")
    return boxes.withColumn("_jump", F.coalesce(jump, F.lit(0))).withColumn("label", F.sum("_jump").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)).cast("long")).drop("_jump")


def reach_trees(values: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (lengths, i, j) of a least spanning tree over each row of sorted values, in the order in which they are found.

    A length is the distance of two values, or that of the ``samples``-th value about either, itself counted, if it is more. For each row of values, one row of lengths is held at a time.
    """
    m, n = values.shape
    k = min(samples, n)
    core = np.full((m, n), np.inf)
    for back in range(k):  # runs of k values, of which one's own is that many from the left
        i = np.arange(back, n - (k - 1 - back))
        core[:, i] = np.minimum(core[:, i], np.maximum(values[:, i] - values[:, i - back], values[:, i + k - 1 - back] - values[:, i]))
    near, at, left, now, rows = np.full((m, n), np.inf), np.zeros((m, n), int), np.ones((m, n), bool), np.zeros(m, int), np.arange(m)
    lengths, sources, ends = np.zeros((m, max(n - 1, 0))), np.zeros((m, max(n - 1, 0)), int), np.zeros((m, max(n - 1, 0)), int)
    for step in range(n - 1):
        left[rows, now] = False
        near[rows, now] = np.inf
        length = np.maximum(np.maximum(core, core[rows, now][:, None]), np.abs(values - values[rows, now][:, None]))
        closer = left & (length < near)
        np.copyto(near, length, where=closer)
        np.copyto(at, now[:, None], where=closer)
        now = np.argmin(near, axis=1)
        lengths[:, step], sources[:, step], ends[:, step] = near[rows, now], at[rows, now], now
    return lengths, sources, ends


def reach_tree(values: np.ndarray, samples: int) -> list[tuple[float, int, int]]:
    """Edges (length, i, j) of one row of ``reach_trees``, by increasing length."""
    return _by_length(*(x[0] for x in reach_trees(values[None, :], samples)))


def _by_length(lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[float, int, int]]:
    return sorted(zip(lengths.tolist(), i.tolist(), j.tolist()))


def density_labels(values: list[float], samples: int, smallest: int = 5, tree: list[tuple[float, int, int]] | None = None) -> list[int]:
    """Labels of values by hierarchical density (Campello et al., 2013): -1 is noise, clusters count from the left.

    The tree of merges is cut where both parts are of at least ``smallest`` values; of a cluster and those within it, that of the greater excess of mass is taken, and never the whole. ``tree``: the values' ``reach_tree``, where it is known.
    """
    order = np.argsort(values, kind="stable")
    n = len(order)
    if n < 2 * smallest:  # the whole is no cluster, and no two fit
        return [-1] * n
    parts: list[tuple[float, int, int, int]] = [(0.0, -1, -1, 1)] * n  # length, two parts, size; the values come first
    top = list(range(n))  # by a value's root, the part it is in
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for length, i, j in reach_tree(np.asarray(values, float)[order], samples) if tree is None else tree:
        i, j = find(i), find(j)
        parts.append((length, top[i], top[j], parts[top[i]][3] + parts[top[j]][3]))
        root[j], top[i] = i, len(parts) - 1

    def members(part: int) -> list[int]:
        out, todo = [], [part]
        while todo:
            p = todo.pop()
            if p < n:
                out.append(p)
            else:
                todo += parts[p][1:3]
        return out

    mass, inner, start = [0.0], [[]], [len(parts) - 1]
    todo = [(len(parts) - 1, 0, 0.0)]  # part, cluster, density at which the cluster began
    while todo:
        part, cluster, begun = todo.pop()
        length, *two, _ = parts[part]
        density = 1 / max(length, 1e-12)
        large = [p for p in two if parts[p][3] >= smallest]
        if len(large) == 2:
            mass[cluster] += (density - begun) * parts[part][3]
            for p in two:
                inner[cluster].append(len(mass))
                todo.append((p, len(mass), density))
                mass.append(0.0), inner.append([]), start.append(p)
        else:
            mass[cluster] += (density - begun) * sum(parts[p][3] for p in two if p not in large)
            todo += [(p, cluster, begun) for p in large]
    taken: list[list[int]] = [[] for _ in mass]
    for c in range(len(mass) - 1, -1, -1):
        within = sum(mass[k] for k in inner[c])
        if c and mass[c] >= within:
            taken[c] = [c]
        else:
            mass[c], taken[c] = max(mass[c], within), [t for k in inner[c] for t in taken[k]]
    out = [-1] * n
    for label, own in enumerate(sorted(sorted(members(start[c])) for c in taken[0])):
        for i in own:
            out[order[i]] = label
    return out


TREES = 1 << 18  #: values of pages whose trees are grown together


def density_labels_of_pages(pages: list[list[float]], samples: list[int]) -> list[list[int]]:
    """``density_labels`` of each page. Trees of pages of one length grow together."""
    alike: dict[tuple[int, int], list[int]] = {}
    for p, values in enumerate(pages):
        alike.setdefault((len(values), samples[p]), []).append(p)
    out: list[list[int]] = [[] for _ in pages]
    for (n, least), own in alike.items():
        step = max(1, TREES // max(n, 1))
        for k in range(0, len(own), step):
            some = own[k : k + step]
            if n < 10:  # too few for a tree
                trees = [None] * len(some)
            else:
                trees = map(_by_length, *reach_trees(np.sort(np.array([pages[p] for p in some], float), axis=1, kind="stable"), least))
            for p, tree in zip(some, trees):
                out[p] = density_labels(pages[p], least, tree=tree)
    return out


def page_labels(pages: list[list[float]], clusterer: Callable[[list[float], int], list[int]]) -> list[list[int]]:
    """Labels of each page's values: all noise is tried again with 2, and is one group after that."""
    each = density_labels_of_pages if clusterer is density_labels else lambda some, least: [list(clusterer(v, k)) for v, k in zip(some, least)]
    out = each(pages, [min(10, max(len(v) // 2, 1)) for v in pages])
    noise = [p for p, labels in enumerate(out) if all(k == -1 for k in labels)]
    for p, labels in zip(noise, each([pages[p] for p in noise], [2] * len(noise))):
        out[p] = [0] * len(labels) if all(k == -1 for k in labels) else labels
    return out


def clustered_groups(boxes: DataFrame, page: str, x: str, clusterer: Callable[[list[float], int], list[int]] = density_labels) -> DataFrame:
    """L7 by density; a ``clusterer`` takes (values, least samples) and gives labels: all noise is tried again with 2, and is one group after that.

    Only the values of ``x`` leave the JVM, an array for each page."""

    @F.arrow_udf("array<long>")
    def labels(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array(page_labels([[math.nan if v is None else v for v in values] for values in b.to_pylist()], clusterer), pa.list_(pa.int64()))

    pages = boxes.groupBy(page).agg(F.collect_list(F.struct(*(F.col(c) for c in boxes.columns))).alias("_rows"))
    pages = pages.select("_rows", labels(F.transform("_rows", lambda r: r[x])).alias("_labels"))
    each = pages.select(F.explode_outer(F.arrays_zip("_rows", "_labels")).alias("_each"))
    return each.select("_each._rows.*", F.col("_each._labels").alias("label"))


def column_bounds(groups: DataFrame, page: str, box: str = "box", share: float = 0.02) -> DataFrame:
    """(page, label, box): the padded bounds of each group but noise."""
    b = F.col(box)
    out = groups.where(P.not_noise(F.col("label"))).groupBy(page, "label").agg(F.min(b["x1"]).alias("x1"), F.min(b["y1"]).alias("y1"), F.max(b["x2"]).alias("x2"), F.max(b["y2"]).alias("y2"))
    return out.select(page, "label", G.pad(F.struct("x1", "y1", "x2", "y2"), share).alias("box"))


def natural_key(name: Column) -> Column:
    """Sorts digits in a name by value."""
    return F.array_join(F.transform(F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), 1), lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 20, "0")).otherwise(x)), "")


def region_of_interest(blocks: DataFrame, page: str, page_area: str, share: float) -> DataFrame:
    """(page, xmin, ymin, xmax, ymax) over blocks x, y, w, h of at least a share of the page; nulls where none is left."""
    keep = G.large_enough(F.col("w"), F.col("h"), F.col(page_area), share)
    when = lambda c: F.when(keep, c)
    return blocks.groupBy(page).agg(F.min(when(F.col("x"))).alias("xmin"), F.min(when(F.col("y"))).alias("ymin"), F.max(when(F.col("x") + F.col("w"))).alias("xmax"), F.max(when(F.col("y") + F.col("h"))).alias("ymax"))


def split_line(lines: DataFrame, page: str, middle: str, margin: float) -> DataFrame:
    """(page, split_x): the mean of the middle lines' centres, cut to an integer."""
    own = lines.where(G.middle_line(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.col(middle), margin))
    return own.groupBy(page).agg(F.avg((F.col("x1") + F.col("x2")) / 2).cast("int").alias("split_x"))


def gutter(profile: DataFrame, page: str, width: str) -> DataFrame:
    """(page, split_x) from ink per column x: between the first and the last minimum of the middle fifth."""
    lo, hi = F.floor(F.col(width) * 0.4), F.floor(F.col(width) * 0.6)
    region = profile.where((F.col("x") >= lo) & (F.col("x") < hi))
    ends = region.groupBy(page).agg(F.min(F.struct("ink", "x")).getField("x").alias("first"), F.min(F.struct(F.col("ink"), (-F.col("x")).alias("x"))).getField("x").alias("last"), F.min(lo).alias("lo"), F.min(hi).alias("hi"))
    n, first, last = F.col("hi") - F.col("lo"), F.col("first") - F.col("lo"), F.col("hi") - 1 + F.col("last")
    return ends.select(page, (F.col("lo") + F.floor((first + (n - last)) / 2)).cast("long").alias("split_x"))


def columns_of_pages(boxes: DataFrame, page: str, box: str = "box", text: str = "text", gap: float | None = None, clusterer: Callable[[list[float], int], list[int]] = density_labels) -> DataFrame:
    """(page, col_no, box): text boxes grouped (by density, or by ``gap`` where one is given), bounded, padded, merged and ordered from the left. Pages without columns give no rows."""
    mids = boxes_and_midpoints(boxes, text, box).select(page, box, F.col("mid.x").alias("_x"))
    grouped = clustered_groups(mids, page, "_x", clusterer) if gap is None else gap_groups(mids, page, "_x", gap)
    bounds = column_bounds(grouped, page, box)
    merged = bounds.groupBy(page).agg(F.collect_list("box").alias("b"))
    return numbered_items(merged, [page], F.array_sort(merge_columns(F.array_sort("b"))), "col_no", "box")
