"""Sinks: text, JSON, CSV with an index, quarantine, image crops."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .files import exists


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which all executors share; a temporary folder where none is set in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = own.get() if own.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="leafmill-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/leafmill/{what}-{uuid.uuid4().hex}"


def staged(df: DataFrame, what: str) -> DataFrame:
    """``df`` written in the shared folder and read again."""
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(spark: SparkSession, folder: str, name: str) -> str:
    """K4: ``name``, or ``name_0``, ``name_1``, ... while its JSON is there already."""
    out, k = name, 0
    while exists(spark, f"{folder}/{out}.json"):
        out, k = f"{name}_{k}", k + 1
    return out


def save_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: the one string column of ``df``, a file for each partition; ``append`` adds to what is there."""
    df.write.mode(mode).text(path)


def save_json(df: DataFrame, path: str) -> str:
    """K2: one JSON object on each line; the suffix is added where it is missing."""
    path = path if path.endswith(".json") else f"{path}.json"
    df.write.mode("overwrite").json(path)
    return path


def by_division(records: DataFrame, division: str = "division", record: str = "record", order: list[str] | None = None) -> DataFrame:
    """K2: (division, records), the shape of the exported document, in order within each division."""
    keys = order or [division]
    packed = F.transform(F.array_sort(F.collect_list(F.struct(*keys, record))), lambda x: x[record])
    return records.groupBy(division).agg(packed.alias("records"))


def export_json(records: DataFrame, division: str = "division", record: str = "record", order: list[str] | None = None) -> str:
    """K2: one catalogue's document, {division: [records]}, as text for the driver; for a single catalogue, not for a corpus."""
    rows = by_division(records, division, record, order).select(division, F.to_json("records").alias("j")).orderBy(division).toLocalIterator()
    return json.dumps({r[0]: json.loads(r["j"]) for r in rows}, indent=4, ensure_ascii=False)


def indexed(df: DataFrame, order: list[str], column: str = "index") -> DataFrame:
    """K3: ``df`` with its place under ``order``, from 0, counted in ranges: no task has all rows. The driver gets a count for each range."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = {r["_range"]: r["count"] for r in ranged.groupBy("_range").count().collect()}
    before, total = {}, 0
    for k in sorted(counts):
        before[k], total = total, total + counts[k]
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    lead = F.element_at(F.from_json(F.lit(json.dumps({str(k): v for k, v in before.items()})), "map<string,bigint>"), F.col("_range").cast("string")) if before else F.lit(0)
    return ranged.withColumn(column, (lead + place).cast("long")).drop("_range").select(column, *df.columns)


def save_csv(flat: DataFrame, path: str, order: list[str]) -> None:
    """K3: flat records with a header and an index column without a name, in order."""
    rows = indexed(flat, order)
    rows.select(F.col("index").alias(""), *flat.columns).sortWithinPartitions("").write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def save_quarantine(rows: DataFrame, path: str) -> None:
    """K7: what failed, appended."""
    rows.write.mode("append").parquet(path)


def crop_names(name: str, parts: int) -> list[str]:
    """K8: names of an image's parts."""
    stem, suffix = name.split(".")[0], name.split(".")[-1]
    return [f"{stem}_cropped_{i}.{suffix}" for i in range(1, parts + 1)]


def save_images(images: DataFrame, folder: str) -> DataFrame:
    """K8: (name, length) of images (name, content) written as files of ``folder``, a path that executors share (``file:`` or mounted). Null contents are passed over."""
    target = folder.removeprefix("file:")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.makedirs(target, exist_ok=True)
        for f in frames:
            out = []
            for name, content in zip(f["name"], f["content"]):
                if content is not None:
                    part = os.path.join(target, f".{name}.{uuid.uuid4().hex}")
                    with open(part, "wb") as to:
                        to.write(content)
                    os.replace(part, os.path.join(target, name))  # a task that runs twice leaves one file
                    out.append((name, len(content)))
            yield pd.DataFrame(out, columns=["name", "length"]).astype({"length": "int64"})

    return images.select("name", "content").mapInPandas(run, "name string, length long")
