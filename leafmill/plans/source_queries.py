"""Queries over sources and sinks: tables written in the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files, sinks
from .shared import table

_RECORD = "doc_id long, source string, text string"


def q_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of texts, written as text and appended to, read as whole files; counts of lines and characters."""
    path = sinks.shared_path(spark, "texts")
    docs = table(spark, sf_dir, "documents").where("text is not null")
    sinks.save_text(docs.where("doc_id % 2 = 0").select("text"), path)
    sinks.save_text(docs.where("doc_id % 2 = 1").select("text"), path, "append")
    lines = files.read_text(spark, path).select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.where("line <> ''").groupBy("line").agg(F.count("*").alias("n"))


def q_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as lines of JSON and read back under a schema."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    path = sinks.save_json(docs, sinks.shared_path(spark, "records"))
    return files.read_records(spark, path, _RECORD, lines=True)


def q_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat records as CSV with an index, read back as an evaluation table; texts hold quotes, commas and line ends."""
    docs = table(spark, sf_dir, "documents").where("text <> ''")
    flat = docs.select(F.col("source").alias("family_name"), F.col("doc_id").cast("string").alias("species_name"), F.concat(F.lit('"a", '), "text").alias("description"))
    path = sinks.shared_path(spark, "flat")
    sinks.save_csv(flat, path, ["species_name", "description"])
    return files.read_evaluation(spark, path).select("family_name", "species_name", "description")


def q_image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two suffixes in one folder, of which the source takes images."""
    pages = table(spark, sf_dir, "pages").where("html is not null").select("page_id", F.encode("html", "utf-8").alias("content"))
    named = pages.select(F.concat(F.lit("scan"), "page_id", F.when(F.col("page_id") % 3 == 0, ".txt").otherwise(".png")).alias("name"), "content").dropDuplicates(["name"])
    path = sinks.shared_path(spark, "images")
    sinks.save_images(named, path).agg(F.sum("length")).collect()
    return files.load_files(spark, path).select("name", F.sha2("content", 256).alias("sha"), "length")


SQL = {
    "q_text_files": "with l as (select unnest(string_split(text, chr(10))) as line from documents where text is not null) select line, count(*) as n from l where line <> '' group by line",
    "q_json_files": "select doc_id, source, text from documents",
    "q_csv_files": "select source as family_name, cast(doc_id as varchar) as species_name, '\"a\", ' || text as description from documents where text <> ''",
    "q_image_files": "select 'scan' || page_id || '.png' as name, sha256(html) as sha, octet_length(encode(html)) as length from pages where html is not null and page_id % 3 <> 0",
}

QUERIES = {f.__name__: f for f in (q_text_files, q_json_files, q_csv_files, q_image_files)}
