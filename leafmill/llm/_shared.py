"""What several operators of this subpackage need: tables, written stages, components."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = root.get() if root.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="leafmill-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written inside, but for what is to last, is deleted at the end."""
    own: list[str] = []
    before = _SCRATCH.set(own)
    try:
        yield
    finally:
        _SCRATCH.reset(before)
        for path in own:
            drop_path(spark, path)


def shared_path(spark: SparkSession, what: str, lasting: bool = False) -> str:
    path = f"{shared_dir(spark)}/leafmill/{what}-{uuid.uuid4().hex}"
    if not lasting and _SCRATCH.get() is not None:
        _SCRATCH.get().append(path)
    return path


def written(df: DataFrame, what: str, lasting: bool = False) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: its lineage is cut and it is computed once."""
    path = shared_path(df.sparkSession, what, lasting)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positional(df: DataFrame) -> DataFrame:
    """``df`` with its columns named by their place, so that none has a name an operator uses itself; ``toDF(*df.columns)`` undoes it."""
    return df.toDF(*(f"_at{i}" for i in range(len(df.columns))))


def row_marks(df: DataFrame) -> list[Column]:
    """128 bits, as two longs, that tell rows apart by all their columns."""
    kept = [F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in df.dtypes]
    holes = F.concat(*(F.when(F.col(c).isNull(), "1").otherwise("0") for c in df.columns))
    return [F.xxhash64(holes, *kept).alias("_mark_a"), F.xxhash64(F.lit("again"), holes, *kept).alias("_mark_b")]


def one_of_equal(marked: DataFrame) -> DataFrame:
    """One of each set of rows with equal ``row_marks``. Copies go on the reading side already, so that no number of them meets in one task."""
    return marked.groupBy("_mark_a", "_mark_b").agg(F.any_value(F.struct(*(c for c in marked.columns if not c.startswith("_mark_")))).alias("_row")).select("_mark_a", "_mark_b", "_row.*")


def local_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few rows from the driver, as a literal of the plan."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{', '.join(':'.join(c.split()) for c in schema.split(', '))}>>")))


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst: long); component: the smallest node reachable.

    Alternating large and small stars (Kiveris et al., 2014). Each star is an
    aggregation and an equi-join, so a hub's neighbours are dealt over tasks by
    adaptive skew handling; every round is written to the shared folder.
    """
    spark = edges.sparkSession
    e = (
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
        .distinct()
    )
    path = shared_path(spark, "edges")
    e.write.parquet(path)
    mark = None
    for _ in range(max_rounds):
        e = spark.read.schema("a long, b long").parquet(path)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        old, path = path, shared_path(spark, "edges")
        small.write.parquet(path)
        drop_path(spark, old)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
