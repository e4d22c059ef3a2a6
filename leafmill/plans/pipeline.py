"""The whole way from page images or extracted text to flat records, and its command line."""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonx as J
from ..functions import prompts as R
from ..functions import text as T
from ..operators import backends as B
from ..operators import images as I
from ..operators import layout as L
from ..operators import segment as S
from ..sources import files, sinks


@dataclass
class Result:
    text: DataFrame
    blocks: DataFrame | None = None
    records: DataFrame | None = None
    failed: DataFrame | None = None
    flat: DataFrame | None = None


def page_texts(images: DataFrame, model: str = "plain", clean: bool = True) -> DataFrame:
    """M3, M4: (catalogue, name, text) of images (catalogue, name, content): recognised, and cleaned page by page."""
    found = B.recognized(images, model).select("catalogue", "name", "text")
    return found.withColumn("text", T.clean_page(F.col("text"))) if clean else found


def corpus(pages: DataFrame) -> DataFrame:
    """M3: (catalogue, text): each catalogue's pages in natural order, each after a line feed."""
    ordered = F.array_sort(F.collect_list(F.struct(L.natural_key(F.col("name")).alias("k"), "name", "text")))
    return pages.groupBy("catalogue").agg(F.array_join(F.transform(ordered, lambda x: F.concat(F.lit("\n"), x["text"])), "").alias("text"))


def transcribe(text: DataFrame, config: R.Config, keys: list[str] | None = None, entities=None, mode: str = "compat") -> Result:
    """(catalogue, text) to blocks, records and flat records. Rows of empty text are left out."""
    keys = keys or ["catalogue"]
    own = text.where("text is not null and text <> ''")
    blocks = S.text_blocks(S.structure(own, keys, config.divisions, entities=entities, max_chunk=config["max_chunk_size"], mode=mode), keys)
    rows = sinks.staged(B.transcribed(blocks, config), "transcribed")  # a model is asked once
    good = B.accepted(rows)
    flat = J.flatten(good, [*keys, "div_ord", "fam_ord", "block", "division"], mode=mode)
    return Result(text, blocks, good, B.quarantine(rows), flat)


def read_images(spark: SparkSession, root: str, config: R.Config, cropper: I.Cropper | None = None, pdf=None) -> DataFrame:
    """(catalogue, name, content) of a folder, cropped where the configuration asks for it."""
    folder, crop = files.data_dir(spark, root, bool(config["crop"]))
    found = files.load_files(spark, folder)
    if pdf:
        found = files.pdf_pages(found, pdf)
    images = found.select("name", "content")
    if crop and cropper:
        images = I.cropped(images, cropper)
    return images.withColumn("catalogue", F.lit(root.rstrip("/").rpartition("/")[2]))


def run(spark: SparkSession, root: str, config: R.Config, ocr_only: bool = False, test: bool = False, cropper: I.Cropper | None = None, pdf=None, entities=None, mode: str = "compat") -> Result:
    """A folder to records. Text that an earlier run has left is taken as it is; ``test`` reads its first characters only."""
    cached = files.cached_text(spark, root)
    if cached is not None:
        text = cached.select(F.lit(root.rstrip("/").rpartition("/")[2]).alias("catalogue"), "text")
    else:
        images = read_images(spark, root, config, cropper, pdf)
        text = sinks.staged(corpus(page_texts(images, config["ocr_extraction_model"] or "plain")), "corpus")
    if ocr_only:
        return Result(text)
    if test:
        text = text.withColumn("text", S.trial_prefix(F.col("text")))
    return transcribe(text, config, entities=entities, mode=mode)


def save(result: Result, config: R.Config) -> str:
    """Records as JSON and CSV under a name that is free; returns the name."""
    spark = result.text.sparkSession
    folder = config["output_save_path"].rstrip("/")
    name = sinks.free_name(spark, folder, config["output_save_file_name"])
    sinks.save_json(result.records.select("catalogue", "div_ord", "fam_ord", "block", "division", "record"), f"{folder}/{name}")
    sinks.save_csv(result.flat, f"{folder}/{name}.csv", ["catalogue", "div_ord", "fam_ord", "block", "species_name", "description"])
    sinks.save_quarantine(result.failed, f"{folder}/{name}_errors")
    return name


def parser() -> argparse.ArgumentParser:
    """X10."""
    p = argparse.ArgumentParser(prog="leafmill", description="Scanned catalogues to records.")
    p.add_argument("images", help="a folder of page images or of extracted text")
    p.add_argument("prompt", help="the catalogue's configuration, YAML")
    p.add_argument("--ocr-only", action="store_true", help="stop after the text")
    p.add_argument("--test", action="store_true", help="a trial with the first characters of the text")
    return p


def main(args: list[str] | None = None) -> None:
    own = parser().parse_args(args)
    spark = SparkSession.builder.appName("leafmill").getOrCreate()
    config = R.Config(files.load_config(spark, own.prompt))
    log = R.get_logger("leafmill")
    log.warning("\n%s", config.described())
    result = run(spark, own.images, config, own.ocr_only, own.test)
    if own.ocr_only:
        sinks.save_text(result.text.select("text"), f"{own.images.rstrip('/')}/{files.CACHED_TEXT}")
    else:
        log.warning("saved as %s", save(result, config))


if __name__ == "__main__":
    main()
