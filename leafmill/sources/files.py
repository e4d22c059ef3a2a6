"""Sources: image and text files, cached text, JSON, CSV, configuration.

All listing and reading goes through Hadoop's file systems, so that any path
Spark can read is one for these too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Types

from ..functions import predicates as P

CROPPED = "cropped"
EXTRACTED = "extracted_images"
CACHED_TEXT = "extracted_text.txt"
EVAL_SCHEMA = "family_name string, species_name string, description string"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def is_file(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isFile())


def has_files(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory() and len(fs.listStatus(p)))


def load_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, length, content) of a single file, whose suffix counts in any case, or of a folder's own files by their suffix as it is, without those ignored. ``content`` is read only where it is used."""
    single = is_file(spark, path)
    files = spark.read.format("binaryFile").load(path)
    named = files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "content")
    kept = P.accepted_suffix(F.col("name"), any_case=single)
    return named.where(kept) if single else named.where(kept & P.not_ignored(F.col("name")))


def data_dir(spark: SparkSession, root: str, crop: bool) -> tuple[str, bool]:
    """S3: the folder to read, and whether its images are still to be cropped. Crops that are there come first, then pages taken out of a PDF, then the folder itself; FileNotFoundError where there is nothing."""
    pages = f"{root}/{EXTRACTED}"
    if crop:
        for d in (f"{root}/{CROPPED}", f"{pages}/{CROPPED}"):
            if has_files(spark, d):
                return d, False
    found = pages if has_files(spark, pages) else root
    if not exists(spark, found) or load_files(spark, found).limit(1).select("name").isEmpty():
        raise FileNotFoundError(f"no images or PDFs under {root}")
    return found, crop


def pdf_pages(files: DataFrame, backend: Callable[[bytes], list[bytes]]) -> DataFrame:
    """PDFs as rows of their pages, named ``<pdf>_<n>.png`` from 1; other files pass through. ``backend``: the pages' images of a PDF's bytes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples(index=False):
                if not row.name.lower().endswith(".pdf"):
                    yield pd.DataFrame([row])
                    continue
                stem = row.name.split(".")[0]
                pages = backend(row.content)
                if pages:
                    yield pd.DataFrame([(row.path, f"{stem}_{i}.png", len(p), p) for i, p in enumerate(pages, 1)], columns=f.columns)

    return files.select("path", "name", "length", "content").mapInPandas(run, "path string, name string, length long, content binary")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text), a row for each whole file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def cached_text(spark: SparkSession, root: str) -> DataFrame | None:
    """The text that an earlier run has left, or None."""
    path = f"{root}/{CACHED_TEXT}"
    return read_text(spark, path) if exists(spark, path) else None


def load_config(spark: SparkSession, path: str | None) -> dict | None:
    """A YAML file of any file system, as a dict of the driver's; None for no path."""
    import yaml

    if path is None:
        return None
    return yaml.safe_load(spark.read.text(path, wholetext=True).first()[0])


def read_records(spark: SparkSession, source, schema: str, lines: bool = False) -> DataFrame:
    """JSON from a path or a dict, under a schema; ValueError for anything else. A file is one object, or with ``lines`` one for each line."""
    import json

    if isinstance(source, dict):
        return spark.range(1).select(F.from_json(F.lit(json.dumps(source)), schema).alias("r")).select("r.*")
    if isinstance(source, str) and exists(spark, source):
        return spark.read.schema(Types._parse_datatype_string(schema)).json(source, multiLine=not lines)
    raise ValueError(f"{source!r} is no JSON file or object")


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """A gold or predicted table with ``row_no``, its file's path and its place there, which sorts in the files' order. A leading index column is passed over."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    # One task reads a whole file in order, but Spark deals files by size, so the path comes first.
    rows = raw.withColumn("row_no", F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place")))
    return rows.select("row_no", "family_name", "species_name", "description")
