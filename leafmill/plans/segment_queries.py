"""Queries over segmentation and chunking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunk as C
from ..operators import segment as S
from .shared import CATALOGUE, DIVISIONS, ENTITIES, feature, feature_sql, stripped, table, whole_text
from .text_queries import PREPARED


def catalogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", feature(CATALOGUE).alias("text"))


def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))


def exploded(df: DataFrame, items, name: str) -> DataFrame:
    return C.numbered_items(df, ["doc_id"], items, "i", name).select("doc_id", F.col("i").cast("long").alias("i"), name)


def q_split_div(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1, G2, P7, P8."""
    out = S.split_by_divisions(catalogues(spark, sf_dir), ["doc_id"], DIVISIONS)
    return out.withColumn("div_ord", F.col("div_ord").cast("long"))


def q_split_div_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: fragments that ``compat`` has no division for, over texts that begin with a lower-case mention."""
    docs = plain(spark, sf_dir).withColumn("text", F.concat(F.lit("filices first, "), F.col("text"), F.lit(" Filices then")))
    return S.orphans(docs, ["doc_id"], DIVISIONS).withColumn("ord", F.col("ord").cast("long"))


def q_split_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3."""
    out = S.split_by_families(catalogues(spark, sf_dir), ["doc_id"])
    return out.withColumn("fam_ord", F.col("fam_ord").cast("long"))


def q_family_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 over plain texts, most of which have no family."""
    out = S.split_by_families(plain(spark, sf_dir), ["doc_id"])
    return out.withColumn("fam_ord", F.col("fam_ord").cast("long"))


def q_split_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 with the species shape."""
    out = S.split_records(catalogues(spark, sf_dir), ["doc_id"])
    return out.withColumn("rec", F.col("rec").cast("long"))


def q_split_record_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4, P9 to P11 with entities."""
    docs = catalogues(spark, sf_dir).withColumn("entities", F.array(*map(F.lit, ENTITIES)))
    out = S.split_records(docs, ["doc_id"], entities="entities")
    return out.withColumn("rec", F.col("rec").cast("long"))


def q_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from raw catalogue to blocks."""
    blocks = S.text_blocks(S.structure(catalogues(spark, sf_dir), ["doc_id"], DIVISIONS), ["doc_id"])
    return blocks.select("doc_id", *(F.col(c).cast("long").alias(c) for c in ("div_ord", "fam_ord", "block")), "division", "family", "content")


def q_species_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of mentions."""
    found = S.species_mentions(F.col("text"))
    return catalogues(spark, sf_dir).select("doc_id", F.size(found).cast("long").alias("n"), F.array_join(found, "|").alias("mentions"))


def q_stride_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G9."""
    return exploded(table(spark, sf_dir, "documents").where("text is not null"), S.stride_windows(F.col("text")), "window_text")


def q_trial_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trial run's first 5000 characters."""
    return table(spark, sf_dir, "documents").select("doc_id", S.trial_prefix(F.col("text")).alias("head"))


def q_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and paragraphs."""
    return catalogues(spark, sf_dir).select("doc_id", F.size(S.lines(F.col("text"))).cast("long").alias("n_lines"), F.array_join(S.paragraphs(F.col("text")), "|").alias("paragraphs"))


def q_pack_major(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 over lines."""
    return exploded(plain(spark, sf_dir), C.group_major(S.lines(F.col("text")), 1000), "chunk")


def q_pack_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 over lines; the line that overflows is lost, as in ``compat``."""
    return exploded(plain(spark, sf_dir), C.pack_paragraphs(S.lines(F.col("text")), 400), "chunk")


def q_pack_paragraphs_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 without loss."""
    return exploded(plain(spark, sf_dir), C.pack_paragraphs(S.lines(F.col("text")), 400, mode="safe"), "chunk")


def q_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chunk with the last words of the one before."""
    chunks = C.add_overlap(C.pack_paragraphs(S.lines(F.col("text")), 400), 5)
    return exploded(plain(spark, sf_dir), chunks, "chunk")


def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4, the tokens."""
    tokens = C.clean_tokens(F.col("text"))
    return plain(spark, sf_dir).select("doc_id", F.size(tokens).cast("long").alias("n"), F.array_join(tokens, " ").alias("tokens"))


def q_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 with spans: each token is the stripped slice of its text."""
    return C.token_rows(plain(spark, sf_dir), ["doc_id"], "text")


def q_fuzzy_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5, C6 over passages cut with an overlap, which the merge takes out again."""
    words = F.split(F.col("text"), " ")
    n = F.size(words)
    a, b = F.array_join(F.slice(words, F.lit(1), F.ceil(n / 2).cast("int") + 4), " "), F.array_join(F.slice(words, F.greatest(F.lit(1), F.ceil(n / 2).cast("int") - 4), n), " ")
    return table(spark, sf_dir, "benchmark").where("text is not null").select("item_id", C.merge_all(10, 5)(F.array(a, b)).alias("merged"))


def q_batches10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation in batches of ten."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", C.batch_number(F.col("turn")).alias("batch"), F.length("text").alias("chars"))
    return turns.groupBy("conv_id", "batch").agg(F.count("*").alias("n"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"))


def q_corpus_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: pages of one document put together in order, each after a line feed."""
    turns = table(spark, sf_dir, "conversations").where("text is not null")
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.concat(F.lit("\n"), x["text"])), "").alias("corpus"))


_FEATURE = f"f as (select doc_id, {feature_sql(CATALOGUE)} as t from documents)"
_PLAIN = f"f as (select doc_id, {feature_sql()} as t from documents)"
_DIV = r"(?i)(?:\d+\.?\s+)?(Dicotyledones|Monocotyledones|Filices)\.?"
_FAMILY = r"\b([A-Z]+ACEAE|COMPOSITAE|GRAMINEAE|LEGUMINOSAE|PALMAE|UMBELLIFERAE|CRUCIFERAE|LABIATAE|GUTTIFERAE|PAPILIONACEAE|MIMOSACEAE|CAESALPINIACEAE|[A-Z]+EAE)\b"
_HEAD = r"^(?:[0-9]+\.\s?)?(?:\s+|-)?[A-Z][a-z]+ [a-z]+"
_ENTITY_HEAD = r"^(?:[0-9]+\.\s?)?(?:\s+|-)?(?:Rosa canina|Bellis perennis|Poa annua|Not a name)"

#: From f (doc_id, t) to c (doc_id, ord, division, part).
_CARRIED = rf"""
s as (select doc_id, regexp_split_to_array(t, '{_DIV}') as p, regexp_extract_all(t, '{_DIV}', 1) as n from f),
k as (select doc_id, list_filter(flatten(list_transform(range(1, len(p) + 1), lambda i: case when i <= len(n) then [p[i], n[i]] else [p[i]] end)), lambda x: x <> '' and not regexp_full_match(x, '\n+')) as k from s),
q as (select doc_id, k, unnest(range(0, len(k) // 2)) as ord from k),
h as (select doc_id, ord, k[2 * ord + 1] as d, k[2 * ord + 2] as body, regexp_matches(k[2 * ord + 1], '^(?:\d+\.?\s+)?(?:[A-Z][a-z]+|[A-Z]+)\.?') as head from q),
c as (select doc_id, ord, last_value(case when head then d end ignore nulls) over (partition by doc_id order by ord) as division, case when head then body else d || body end as part from h)"""
_DIVIDED = "d as (select doc_id, min(ord) as div_ord, division, string_agg(part, '' order by ord) as text from c where division is not null group by doc_id, division)"


def _families(source: str, keys: str, text: str) -> str:
    return rf"""
fs as (select {keys}, {text} as t, regexp_extract_all({text}, '{_FAMILY}', 1) as n, regexp_split_to_array({text}, '{_FAMILY}') as p from {source}),
fu as (select {keys}, unnest(case when len(n) = 0 then [{{'o': 0, 'family': 'No family found', 'text': {stripped('t')}}}] else list_transform(range(1, len(n) + 1), lambda i: {{'o': i - 1, 'family': n[i], 'text': p[i + 1]}}) end) as u from fs),
fam as (select {keys}, u.o as fam_ord, u.family as family, u.text as text from fu)"""


def _records(source: str, keys: str, text: str, head: str) -> str:
    return rf"""
ls as (select {keys}, string_split({text}, chr(10)) as l from {source}),
lu as (select {keys}, unnest(l) as line, generate_subscripts(l, 1) as line_no from ls),
lb as (select {keys}, line_no, {stripped('line')} as line, cast(regexp_matches(line, '{head}') as int) as head from lu where {stripped('line')} <> ''),
ln as (select *, sum(head) over (partition by {keys} order by line_no rows unbounded preceding) as rec from lb),
rec as (select {keys}, cast(rec as bigint) as rec, string_agg(line, chr(10) order by line_no) as record from ln group by {keys}, rec)"""


def _major(items: str, size: int) -> str:
    strip_b, strip_a = stripped("b.cur"), stripped("a.cur")
    return f"""list_reduce(list_prepend({{'cur': '', 'done': []::varchar[]}}, list_transform({items}, lambda x: {{'cur': x, 'done': []::varchar[]}})), lambda a, b:
  case when length(a.cur) + length(b.cur) > {size} then {{'cur': {strip_b}, 'done': list_append(a.done, {strip_a})}} else {{'cur': a.cur || chr(10) || chr(10) || {strip_b}, 'done': a.done}} end)"""


def _major_done(state: str) -> str:
    return f"case when {state}.cur <> '' then list_append({state}.done, {stripped(f'{state}.cur')}) else {state}.done end"


def _paragraphs(size: int, safe: bool) -> str:
    over = "{'cur': b.cur, 'n': b.n, 'done': %s}" if safe else "{'cur': []::varchar[], 'n': 0, 'done': %s}"
    over = over % "case when len(a.cur) > 0 then list_append(a.done, array_to_string(a.cur, chr(10))) else a.done end"
    start = "{'cur': []::varchar[], 'n': 0::bigint, 'done': []::varchar[]}"
    return f"""
w as (select doc_id, list_reduce(list_prepend({start}, list_transform(string_split(t, chr(10)), lambda x: {{'cur': [x], 'n': length(x), 'done': []::varchar[]}})), lambda a, b:
  case when a.n + b.n <= {size} then {{'cur': list_concat(a.cur, b.cur), 'n': a.n + b.n, 'done': a.done}} else {over} end) as z from f),
packed as (select doc_id, case when len(z.cur) > 0 then list_append(z.done, array_to_string(z.cur, chr(10))) else z.done end as chunks from w)"""


_UNPACKED = "select doc_id, cast(unnest(range(0, len(chunks))) as bigint) as i, unnest(chunks) as chunk from packed"
_WORDS = r"list_filter(regexp_split_to_array({}, '\s+'), lambda v: v <> '')"

SQL = {
    "q_split_div": f"with {_FEATURE}, {_CARRIED}, {_DIVIDED} select doc_id, div_ord, division, text from d",
    "q_split_div_orphans": f"with f as (select doc_id, 'filices first, ' || {feature_sql()} || ' Filices then' as t from documents), {_CARRIED} select doc_id, ord, part from c where division is null",
    "q_split_family": f"with {_FEATURE}, {_families('f', 'doc_id', 't')} select doc_id, fam_ord, family, text from fam",
    "q_family_fallback": f"with {_PLAIN}, {_families('f', 'doc_id', 't')} select doc_id, fam_ord, family, text from fam",
    "q_split_record": f"with {_FEATURE}, {_records('f', 'doc_id', 't', _HEAD)} select doc_id, rec, record from rec",
    "q_split_record_entities": f"with {_FEATURE}, {_records('f', 'doc_id', 't', _ENTITY_HEAD)} select doc_id, rec, record from rec",
    "q_text_blocks": f"""
with f as (select doc_id, {PREPARED} as t from documents), {_CARRIED}, {_DIVIDED}, {_families('d', 'doc_id, div_ord, division', 'text')},
{_records('fam', 'doc_id, div_ord, division, fam_ord, family', 'text', _HEAD)},
g as (select doc_id, div_ord, division, fam_ord, family, list(record order by rec) as r from rec group by all),
z as (select *, {_major('r', 3000)} as z from g),
packed as (select doc_id, div_ord, {stripped('division')} as division, fam_ord, family, {_major_done('z')} as chunks from z)
select doc_id, div_ord, fam_ord, cast(unnest(range(0, len(chunks))) as bigint) as block, division, family, unnest(chunks) as content from packed""",
    "q_species_mentions": rf"""
with {_FEATURE}, m as (select doc_id, regexp_extract_all(t, '((?:\d+\.\s)?[A-Z][a-z\-]+(?:\s[a-z\-]+)?(?:\s(?:var\.|subsp\.|f\.)\s[a-z\-]+)?(?:\s[A-Z][a-z\-]+)?(?:\s\([\w\s]+\))?)', 1) as m from f)
select doc_id, len(m) as n, array_to_string(m, '|') as mentions from m""",
    "q_stride_windows": """
with w as (select doc_id, text, unnest(range(0, length(text), 2000)) as p from documents where text is not null)
select doc_id, p // 2000 as i, substr(text, p + 1, 4000) as window_text from w""",
    "q_trial_prefix": "select doc_id, substr(text, 1, 5000) as head from documents",
    "q_paragraphs": rf"with {_FEATURE} select doc_id, len(string_split(t, chr(10))) as n_lines, array_to_string(regexp_split_to_array(t, '\n\s*'), '|') as paragraphs from f",
    "q_pack_major": f"with {_PLAIN}, z as (select doc_id, {_major('string_split(t, chr(10))', 1000)} as z from f), packed as (select doc_id, {_major_done('z')} as chunks from z) {_UNPACKED}",
    "q_pack_paragraphs": f"with {_PLAIN}, {_paragraphs(400, False)} {_UNPACKED}",
    "q_pack_paragraphs_safe": f"with {_PLAIN}, {_paragraphs(400, True)} {_UNPACKED}",
    "q_overlap": f"""
with recursive {_PLAIN}, {_paragraphs(400, False)},
o as (select doc_id, chunks, 1 as k, chunks[1] as chunk from packed where len(chunks) > 0
  union all select doc_id, chunks, k + 1, array_to_string(({_WORDS.format('chunk')})[greatest(1, len({_WORDS.format('chunk')}) - 4):], ' ') || ' ' || chunks[k + 1] from o where k < len(chunks))
select doc_id, cast(k - 1 as bigint) as i, chunk from o""",
    "q_tokens": rf"""
with {_PLAIN}, m as (select doc_id, list_filter(list_transform(regexp_extract_all(t, '\S+'), lambda x: regexp_replace(x, '^[!-/:-@\[-`{{-~]+|[!-/:-@\[-`{{-~]+$', '', 'g')), lambda x: x <> '') as m from f)
select doc_id, len(m) as n, array_to_string(m, ' ') as tokens from m""",
    "q_token_spans": rf"""
with {_PLAIN}, r as (select doc_id, regexp_extract_all(t, '\s+|\S+') as r from f),
u as (select doc_id, unnest(r) as run, generate_subscripts(r, 1) as k from r),
s as (select doc_id, k, length(run) as n, regexp_replace(run, '^[!-/:-@\[-`{{-~]+|[!-/:-@\[-`{{-~]+$', '', 'g') as tok, regexp_full_match(run, '\s+') as blank, cast(sum(length(run)) over (partition by doc_id order by k) as bigint) as e from u)
select doc_id, row_number() over (partition by doc_id order by k) - 1 as i, tok, e - n as s, e from s where not blank and tok <> ''""",
    "q_batches10": "select conv_id, turn // 10 as batch, count(*) as n, cast(coalesce(sum(length(text)), 0) as bigint) as chars from conversations group by 1, 2",
    "q_corpus_concat": "select conv_id, string_agg(chr(10) || text, '' order by turn, role, text) as corpus from conversations where text is not null group by conv_id",
}

QUERIES = {
    f.__name__: f
    for f in (
        q_split_div, q_split_div_orphans, q_split_family, q_family_fallback, q_split_record, q_split_record_entities, q_text_blocks, q_species_mentions, q_stride_windows, q_trial_prefix,
        q_paragraphs, q_pack_major, q_pack_paragraphs, q_pack_paragraphs_safe, q_overlap, q_tokens, q_token_spans, q_fuzzy_merge, q_batches10, q_corpus_concat,
    )
}
