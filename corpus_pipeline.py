"""Documents to packed training sequences: five stages, each over all that the one before has kept.

1. Quality classifier: documents whose lines it finds bad go.
2. Near-duplicates (five-word shingles alike by 0.8 or more): one document of each group stays.
3. Secret scans: secrets are replaced by a placeholder; every document stays.
4. Mixing: documents are taken as often as their domains' targets ask.
5. Packing: token sequences of 2048, as pieces of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import mixing, packing, quality, secrets, similar
from leafmill.llm._shared import table, written
from leafmill.llm.queries import domains, vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality.kept(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.deduplicate(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redacted(docs, secrets.fit(spark))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resampled(docs, domains(spark, sf_dir).join(docs.select("doc_id").distinct(), "doc_id", "left_semi"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-duplicates", near_duplicate_stage),
    ("secret scans", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the classifier, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + "".join(c for c in name if c.isalpha()))
    return docs
