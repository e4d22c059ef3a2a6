"""Queries over the text operators: scans, cleaning, normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T
from .shared import CATALOGUE, DIVISIONS, PAGE, decomposed, feature, feature_sql, nested, stripped, table, whole_text

_NAME = "concat('scan ', page_id, case when page_id % 5 = 0 then '.JPG' when page_id % 5 = 1 then '.png' when page_id % 5 = 2 then '.pdf' when page_id % 5 = 3 then '.txt' else '' end)"


def q_scan_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pruned and filtered scan."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return docs.where(P.whole_pair("text", "source") & P.not_empty(F.col("text"))).select("doc_id", "source", F.length("text").cast("long").alias("n"))


def q_ext_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by suffix, as a single file and as a listed one."""
    names = table(spark, sf_dir, "pages").select("page_id", F.expr(_NAME).alias("name"))
    names = names.unionByName(table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, "cropped").otherwise("Thumbs.db").alias("name")))
    return names.select("page_id", "name", P.accepted_suffix(F.col("name")).alias("single"), P.accepted_suffix(F.col("name"), any_case=False).alias("listed"), P.not_ignored(F.col("name")).alias("seen"))


def q_clean_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 to T8 over framed pages."""
    return table(spark, sf_dir, "documents").select("doc_id", T.clean_page_native(feature(PAGE)).alias("cleaned"))


def q_clean_page_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 to T11."""
    return table(spark, sf_dir, "documents").select("doc_id", T.clean_page(feature(PAGE)).alias("cleaned"))


def q_nfkd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 over whole texts of any language."""
    return table(spark, sf_dir, "documents").select("doc_id", T.nfkd(F.col("text")).alias("decomposed"))


def q_fold_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10."""
    framed = F.concat(F.lit("‘"), F.col("text"), F.lit("’ “"), F.col("source"), F.lit("” – — …"))
    return table(spark, sf_dir, "documents").select("doc_id", T.fold_punctuation(framed).alias("folded"))


def q_drop_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T12 over every turn, some with a remark in front."""
    lead = F.when(F.col("turn") % 3 == 0, "Cleaned text: ").when(F.col("turn") % 3 == 1, "corrected TEXT :\n").otherwise("Cleaned text  : ")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.drop_preamble(F.concat(lead, F.coalesce("text", F.lit("")))).alias("body"))


def q_preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T15 to T24 over framed catalogues."""
    return table(spark, sf_dir, "documents").select("doc_id", T.preprocess(feature(CATALOGUE), DIVISIONS[0]).alias("prepared"))


def q_unligature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T17 on its own."""
    return table(spark, sf_dir, "documents").select("doc_id", T.unligature(F.concat(F.lit("Æ œ æ Œ "), F.col("text"))).alias("plain"))


def q_eval_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T25 to T28."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.concat(F.lit("  \\ "), whole_text(), F.lit("\\ "))).alias("t"))
    return docs.select("doc_id", T.eval_normal(F.col("t")).alias("description"), T.eval_normal(F.col("t"), species=True).alias("species"))


def q_line_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that start with an entity, and its shape."""
    docs = table(spark, sf_dir, "documents").select("doc_id", feature(CATALOGUE).alias("t"))
    one = docs.select("doc_id", "t", F.explode(F.array(*map(F.lit, ("Bellis perennis", "ROSACEAE", "Poa annua", "floret")))).alias("entity"))
    return one.select("doc_id", "entity", F.size(P.line_starts(F.col("t"), F.col("entity"))).cast("long").alias("n"), P.several_words(F.col("entity")).alias("several"), P.species_shaped(F.col("entity")).alias("shaped"))


_T1_8 = (
    (r"\n{2,}", "\n\n"),
    (r"(?m)^\s*\d+\s*$\n?", ""),
    (r"(\w+)-\s*\n\s*(\w+)", r"\1\2"),
    (r"([A-Z]+)\s*(EAE|FAE|EAF)", r"\1EAE"),
    (r"\n{2,}", "\n"),
    (r"[ \t]{2,}", " "),
    (r"^\s+|\s+$", ""),
    (r"\b([A-Z]+ACEAE|COMPOSITAE|GRAMINEAE|LEGUMINOSAE|PALMAE|UMBELLIFERAE|CRUCIFERAE|LABIATAE|GUTTIFERAE|PAPILIONACEAE|MIMOSACEAE|CAESALPINIACEAE)\b", "\n\n\\1\n\n"),
    (r"\n{3,}", "\n\n"),
)
PREPARED = nested(
    f"regexp_replace({feature_sql(CATALOGUE)}, '(?si)^.*?(Dicotyledones)', '\\1')",
    (r"(?m)^(?:Catalogue|catalogue)$", ""),
    ("Æ", "AE"),
    ("œ", "ae"),
    (r"(?: [A-Z]{2,})\.A\.", "EAE"),
    (r"(?: [A-Z]{2,})E(\.|A)?E\.?", "EAE"),
    (r"(?: [A-Z]{2,})ACE(\.|A)?(\.|E)?\.?", "ACEAE"),
    (r"ace(\.|a)?e\.?", "aceae"),
    (r"(?: [A-Z]{2,})FLOR(\.|A)?(\.|E)?\.?", "FLORAE"),
    (r"flor(\.|a)?e", "florae"),
    (r"(?mi)^(?:TRIBE|SERIES)\s+[IVXLCDM\.]+\s*[A-Z.]*$", ""),
)


def _folded(expression: str) -> str:
    return f"""replace(translate({expression}, '‘’“”–—', '''''""--'), '…', '...')"""


_EVAL = f"case when doc_id % 9 <> 0 then replace(lower({stripped(decomposed(f'''concat('  \\ ', {feature_sql()}, '\\ ')'''))}), '\\', '') end"

SQL = {
    "q_scan_docs": "select doc_id, source, cast(length(text) as bigint) as n from documents where text is not null and source is not null and text <> ''",
    "q_ext_filter": f"""
with n as (select page_id, {_NAME} as name from pages union all select page_id, case when page_id % 2 = 0 then 'cropped' else 'Thumbs.db' end from pages),
e as (select *, regexp_extract(name, '[.]([^.]+)$', 1) as ext from n)
select page_id, name, lower(ext) in ('jpeg', 'png', 'jpg', 'pdf') as single, ext in ('jpeg', 'png', 'jpg', 'pdf') as listed,
  name not in ('.DS_Store', '.git', 'Thumbs.db', 'cropped') as seen from e""",
    "q_clean_page": f"select doc_id, {nested(feature_sql(PAGE), *_T1_8)} as cleaned from documents",
    "q_clean_page_full": f"select doc_id, {stripped(_folded(decomposed(nested(feature_sql(PAGE), *_T1_8))))} as cleaned from documents",
    "q_nfkd": f"select doc_id, {decomposed('text')} as decomposed from documents",
    "q_fold_punct": f"""select doc_id, {_folded("'‘' || text || '’ “' || source || '” – — …'")} as folded from documents""",
    "q_drop_preamble": r"""
select conv_id, turn, regexp_replace(case when turn % 3 = 0 then 'Cleaned text: ' when turn % 3 = 1 then 'corrected TEXT :' || chr(10) else 'Cleaned text  : ' end || coalesce(text, ''),
  '^(?i:Cleaned|Corrected)\s(?i:text)\s{0,1}:\s*', '') as body from conversations""",
    "q_preprocess": f"select doc_id, {PREPARED} as prepared from documents",
    "q_unligature": "select doc_id, replace(replace('Æ œ æ Œ ' || text, 'Æ', 'AE'), 'œ', 'ae') as plain from documents",
    "q_eval_norm": f"with n as (select doc_id, {_EVAL} as t from documents) select doc_id, t as description, array_to_string(string_split(t, ' ')[1:3], ' ') as species from n",
    "q_line_starts": rf"""
with f as (select doc_id, {feature_sql(CATALOGUE)} as t from documents), e as (select unnest(['Bellis perennis', 'ROSACEAE', 'Poa annua', 'floret']) as entity)
select doc_id, entity, cast(len(regexp_extract_all(t, '(?m)^' || entity)) as bigint) as n, len(string_split(entity, ' ')) > 1 as several,
  regexp_matches(entity, '^[A-Z][a-z]+ [a-z]+') as shaped from f cross join e""",
}

QUERIES = {f.__name__: f for f in (q_scan_docs, q_ext_filter, q_clean_page, q_clean_page_full, q_nfkd, q_fold_punct, q_drop_preamble, q_preprocess, q_unligature, q_eval_norm, q_line_starts)}
