"""The registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup, fingerprints, mixing, packing, quality, secrets, simhash, token_counts, url_filters, warc
from ._shared import table


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, bad): a page's document is named by the number that ends its path; bad is low quality or toxic."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    pages = url_filters.parsed(table(spark, sf_dir, "pages").select("page_id", "url"))
    ids = pages.select("page_id", F.expr("try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})(?:[.][a-z]+)?/?$', 1), '') as bigint)").alias("doc_id"))
    return ids.where("doc_id is not null").join(labels, "doc_id").select("page_id", "bad")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), page_labels(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"), secrets.fit(spark))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain): the languages of the documents in the labelled table."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("domain")).join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), domains(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


#: Written and read back through archives, against plain SQL over the table.
OP4 = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
q as (select *, min(page_id) over (partition by html) as low from p)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast(1 + ((cast('0x' || substr(h, cast(1 + 5 * (i // 4) as int), 5) as bigint) >> (15 - 5 * (i % 4))) & 31) as int), 1)), '') as payload_digest,
  case when page_id = low then 'response' else 'revisit' end as record_type,
  case when page_id = low then null else low end as refers_to
from q
"""

#: All pairs; links as union of reachable ids.
OP3 = """
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
l as (select a.vec_id as s, b.vec_id as d from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.93),
r as (select vec_id as s, vec_id as d from v union select r.s, l.d from r join l on r.d = l.s)
select v.vec_id, (select count(*) from l where l.s = v.vec_id) as n_links, m.c as component_id, v.vec_id = m.c as kept
from v join (select s, min(d) as c from r group by s) m on m.s = v.vec_id
"""


def queries() -> dict:
    own = (op1_url_filters, op2_packing, op3_embedding_dedup, op4_warc, op5_simhash, op6_fingerprints, op7_secrets, op8_token_counts, op9_mixing, op10_quality)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op3_embedding_dedup": OP3, "op4_warc": OP4}
