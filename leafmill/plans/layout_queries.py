"""Queries over boxes and lines; ``lineitem`` numbers stand in for coordinates, and runs of orders for pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import predicates as P
from ..operators import layout as L
from .shared import table

_BOX = """l_orderkey - l_orderkey % 25 as page, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * 40 as x1, l_extendedprice % 500 as y1,
  l_quantity * 40 + l_discount * 300 + 5 as x2, l_extendedprice % 500 + l_tax * 300 + 5 as y2"""
_LINE = """l_orderkey - l_orderkey % 25 as page, l_orderkey, l_linenumber, cast(l_quantity * 20 as int) as x1, 0 as y1,
  cast(l_quantity * 20 + l_discount * 1500 as int) as x2, 300 as y2, 1000.0 as width"""
_ORDER = "x1, l_orderkey, l_linenumber, l_partkey, l_suppkey, x2, y1, y2"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_split(_BOX)).withColumn("box", F.struct("x1", "y1", "x2", "y2"))


def _split(columns: str) -> list[str]:
    return [c.strip() for c in columns.replace("\n", " ").split(",")]


def _coordinates(b: str) -> list:
    return [F.col(f"{b}.{c}").alias(c) for c in ("x1", "y1", "x2", "y2")]


def q_box_geom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each box against a fixed one."""
    other = F.struct(*(F.lit(v).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), (500.0, 100.0, 900.0, 300.0))))
    b = F.col("box")
    mid, padded, merged = G.midpoint(b), G.pad(b), G.merge_boxes(b, other)
    return boxes(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(mid["x"], 6).alias("mid_x"), F.round(mid["y"], 6).alias("mid_y"), F.round(padded["x1"], 6).alias("pad_x1"), F.round(padded["y2"], 6).alias("pad_y2"),
        F.round(G.iou_value(b, other), 6).alias("overlap"), G.iou(b, other, 0.0).alias("overlaps"), merged["x1"].alias("merged_x1"), merged["y2"].alias("merged_y2"), F.round(G.box_area(b["x2"] - b["x1"], b["y2"] - b["y1"]), 4).alias("area"),
    )


def q_merge_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boxes of each page merged from the left."""
    order = ["x1", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "x2", "y1", "y2"]
    pages = boxes(spark, sf_dir).groupBy("page").agg(F.transform(F.array_sort(F.collect_list(F.struct(*order))), lambda s: F.struct(s["x1"].alias("x1"), s["y1"].alias("y1"), s["x2"].alias("x2"), s["y2"].alias("y2"))).alias("b"))
    out = pages.select("page", F.posexplode(L.merge_columns(F.col("b"))).alias("col_no", "m"))
    return out.select("page", F.col("col_no").cast("long").alias("col_no"), *_coordinates("m"))


def q_gap_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6, L7 by gaps: groups of midpoints."""
    mids = L.boxes_and_midpoints(boxes(spark, sf_dir).withColumn("text", F.lit("x")), "text", "box").withColumn("mid_x", F.col("mid.x"))
    return L.gap_groups(mids, "page", "mid_x", 40.0).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "page", F.round("mid_x", 6).alias("mid_x"), "label")


def q_density_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Midpoints of each page grouped by density."""
    mids = L.boxes_and_midpoints(boxes(spark, sf_dir).withColumn("text", F.lit("x")), "text", "box").select("page", "l_orderkey", "l_linenumber", F.col("mid.x").alias("mid_x"))
    return L.clustered_groups(mids, "page", "mid_x")


def q_cluster_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded bounds of each group; orders' line numbers stand in for labels, the first for noise."""
    groups = boxes(spark, sf_dir).withColumn("label", F.when(F.col("l_linenumber") == 1, -1).otherwise(F.col("l_linenumber") % 3).cast("long"))
    return L.column_bounds(groups, "page").select("page", "label", *(F.round(f"box.{c}", 6).alias(c) for c in ("x1", "y1", "x2", "y2")))


def q_columns_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text boxes to ordered columns; its steps have SQL of their own."""
    own = boxes(spark, sf_dir).withColumn("text", F.lit("x"))
    return L.columns_of_pages(own, "page").select("page", "col_no", *_coordinates("box"))


def q_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each page without small blocks."""
    blocks = boxes(spark, sf_dir).selectExpr("page", "x1 as x", "y1 as y", "x2 - x1 as w", "y2 - y1 as h", "40000.0 as page_area")
    return L.region_of_interest(blocks, "page", "page_area", 0.01)


def q_line_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly vertical lines near the middle."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(*_split(_LINE))
    keep = G.middle_line(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.col("width") / 2, 0.2)
    return lines.where(keep).select("l_orderkey", "l_linenumber", "x1", "x2")


def q_split_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each page is cut."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(*_split(_LINE)).withColumn("middle", F.col("width") / 2)
    return L.split_line(lines, "page", "middle", 0.2).withColumn("split_x", F.col("split_x").cast("long"))


def q_gutter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ink per column, from events' values by user."""
    profile = table(spark, sf_dir, "events").selectExpr("user_id as page", "event_id % 100 as x", "value").groupBy("page", "x").agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("ink")).withColumn("width", F.lit(100))
    return L.gutter(profile, "page", "width")


def q_natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key that puts names in natural order."""
    name = F.concat(F.lit("scan "), F.col("page_id"), F.lit("_cropped_"), F.col("page_id") % 3, F.lit(".png"))
    return table(spark, sf_dir, "pages").select("page_id", L.natural_key(name).alias("natural"))


def q_page_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pages are split and which are resized."""
    sized = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 10).alias("w"), (F.col("p_partkey") % 500).alias("h"))
    return sized.select("p_partkey", G.is_portrait(F.col("w"), F.col("h")).alias("portrait"), G.resizes(F.col("w"), F.col("h"), 0.5).alias("resized"), (~P.is_heading(F.lit("x1"))).alias("body"))


SQL = {
    "q_box_geom": f"""
with b as (select {_BOX} from lineitem),
o as (select *, greatest(0.0, least(x2, 900.0) - greatest(x1, 500.0)) * greatest(0.0, least(y2, 300.0) - greatest(y1, 100.0)) as i, (x2 - x1) * (y2 - y1) as a from b)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, round((x1 + x2) / 2, 6) as mid_x, round((y1 + y2) / 2, 6) as mid_y, round(x1 - (x2 - x1) * 0.02, 6) as pad_x1, round(y2 + (y2 - y1) * 0.02, 6) as pad_y2,
  round(i / (a + 400.0 * 200.0 - i + 1e-5), 6) as overlap, i / (a + 400.0 * 200.0 - i + 1e-5) > 0 as overlaps, least(x1, 500.0) as merged_x1, greatest(y2, 300.0) as merged_y2, round(a, 4) as area from o""",
    "q_merge_columns": f"""
with b as (select {_BOX} from lineitem),
p as (select page, list({{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} order by {_ORDER}) as b from b group by page),
m as (select page, list_reduce(list_transform(b, lambda v: {{'done': []::struct(x1 double, y1 double, x2 double, y2 double)[], 'last': v}}), lambda s, n:
  case when greatest(0.0, least(s.last.x2, n.last.x2) - greatest(s.last.x1, n.last.x1)) * greatest(0.0, least(s.last.y2, n.last.y2) - greatest(s.last.y1, n.last.y1)) > 0
    then {{'done': s.done, 'last': {{'x1': least(s.last.x1, n.last.x1), 'y1': least(s.last.y1, n.last.y1), 'x2': greatest(s.last.x2, n.last.x2), 'y2': greatest(s.last.y2, n.last.y2)}}}}
    else {{'done': list_append(s.done, s.last), 'last': n.last}} end) as s from p),
u as (select page, unnest(list_append(s.done, s.last)) as m, generate_subscripts(list_append(s.done, s.last), 1) as k from m)
select page, cast(k - 1 as bigint) as col_no, m.x1 as x1, m.y1 as y1, m.x2 as x2, m.y2 as y2 from u""",
    "q_gap_cluster": f"""
with b as (select *, (x1 + x2) / 2 as mid_x from (select {_BOX} from lineitem)),
j as (select *, case when mid_x - lag(mid_x) over (partition by page order by mid_x) > 40 then 1 else 0 end as jump from b)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, page, round(mid_x, 6) as mid_x, cast(sum(jump) over (partition by page order by mid_x range unbounded preceding) as bigint) as label from j""",
    "q_cluster_bounds": f"""
with b as (select *, case when l_linenumber = 1 then -1 else l_linenumber % 3 end as label from (select {_BOX} from lineitem)),
g as (select page, label, min(x1) as x1, min(y1) as y1, max(x2) as x2, max(y2) as y2 from b where label <> -1 group by page, label)
select page, cast(label as bigint) as label, round(x1 - (x2 - x1) * 0.02, 6) as x1, round(y1 - (y2 - y1) * 0.02, 6) as y1, round(x2 + (x2 - x1) * 0.02, 6) as x2, round(y2 + (y2 - y1) * 0.02, 6) as y2 from g""",
    "q_roi": f"""
with b as (select page, x1 as x, y1 as y, x2 - x1 as w, y2 - y1 as h from (select {_BOX} from lineitem))
select page, min(x) filter (w * h >= 40000.0 * 0.01) as xmin, min(y) filter (w * h >= 40000.0 * 0.01) as ymin, max(x + w) filter (w * h >= 40000.0 * 0.01) as xmax, max(y + h) filter (w * h >= 40000.0 * 0.01) as ymax from b group by page""",
    "q_line_filter": f"""
with l as (select {_LINE} from lineitem), m as (select *, abs(degrees(atan2(y2 - y1, x2 - x1))) as angle, floor((x1 + x2) / 2.0) as c from l)
select l_orderkey, l_linenumber, x1, x2 from m where angle between 70 and 90 and c > 500 - 100 and c < 500 + 100""",
    "q_split_line": f"""
with l as (select {_LINE} from lineitem), m as (select *, abs(degrees(atan2(y2 - y1, x2 - x1))) as angle, floor((x1 + x2) / 2.0) as c from l)
select page, cast(trunc(avg((x1 + x2) / 2.0)) as bigint) as split_x from m where angle between 70 and 90 and c > 400 and c < 600 group by page""",
    "q_gutter": """
with p as (select user_id as page, event_id % 100 as x, cast(sum(cast(round(value * 100) as bigint)) as bigint) as ink from events group by 1, 2),
r as (select * from p where x >= 40 and x < 60),
e as (select page, first(x order by ink, x) as a, first(x order by ink, x desc) as b from r group by page)
select page, cast(40 + ((a - 40) + (20 - (59 - b))) // 2 as bigint) as split_x from e""",
    "q_natural_sort": """
select page_id, 'scan ' || lpad(cast(page_id as varchar), 20, '0') || '_cropped_' || lpad(cast(page_id % 3 as varchar), 20, '0') || '.png' as natural from pages""",
    "q_page_guards": "select p_partkey, p_size * 10 < p_partkey % 500 as portrait, p_size * 10 * 0.5 > 100 and (p_partkey % 500) * 0.5 > 100 as resized, true as body from part",
}

QUERIES = {f.__name__: f for f in (q_box_geom, q_merge_columns, q_gap_cluster, q_density_groups, q_cluster_bounds, q_columns_of_pages, q_roi, q_line_filter, q_split_line, q_gutter, q_natural_sort, q_page_guards)}
