"""Queries over JSON records, conversations, entities and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonx as J
from ..functions import prompts as R
from ..operators import backends as B
from ..operators import evaluate as E
from ..operators import segment as S
from .segment_queries import SQL as _SEGMENTS
from .segment_queries import catalogues
from .shared import _WHOLE, DIVISIONS, decomposed, feature_sql, stripped, table, whole_text

CONFIG = R.Config(
    {
        "divisions": DIVISIONS,
        "system": {"setup": "You know plants.", "instructions": ["Answer in JSON. ", {"keep": "all text"}], "rules": {"family_name": "as written"}},
        "user": {"text": "Text:\n{extracted_text}\nEnd", "image page": "See the image."},
    }
)

_COUNT = """case when doc_id % 6 = 0 then '"2"' when doc_id % 6 = 1 then '2.0' when doc_id % 6 = 2 then '2.5' when doc_id % 6 = 3 then 'true' when doc_id % 6 = 4 then '"x"' else '3' end"""
_FOLDERS = """case when doc_id % 5 = 0 then '' when doc_id % 5 = 1 then '{"description": "a. one"}' when doc_id % 5 = 2 then '{"description": "b. two", "note": "x y", "k": 3}'
  when doc_id % 5 = 3 then '{"note": "z", "ok": true}' else '{"description": "c. three"}, {"description": "d. four"}' end"""
#: A record of each document: counts in all spellings, folders with other keys, empty lists, absent keys, cut-off objects.
_JSON = f"""concat('{{', case when doc_id % 13 = 0 then '' else concat('"family_name": "FAM', doc_id % 50, 'ACEAE", ') end, '"species": [',
  case when doc_id % 7 = 0 then '' else concat('{{"species_name": "Rosa n', doc_id, '", "number_of_folders": ', {{count}}, ', "number_of_sheets": ', doc_id % 9, ', "folders_and_sheets": [', {_FOLDERS}, ']}}') end,
  ']', case when doc_id % 11 = 0 then '' else '}}' end)"""
_ANY = _JSON.replace("{count}", _COUNT)
_GOOD = _JSON.replace("{count}", "doc_id % 4")


def records(spark: SparkSession, sf_dir: str, expression: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(expression).alias("json"))


def q_json_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records are JSON and hold what they must."""
    return J.verify(records(spark, sf_dir, _ANY)).select("doc_id", "verified", F.col("error").isNull().alias("clean"), F.col("record.family_name").alias("family_name"), F.size("record.species").cast("long").alias("n_species"))


def q_json_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 over every spelling of a count."""
    return table(spark, sf_dir, "documents").select("doc_id", J.lax_int(F.expr(_COUNT.replace('"', ""))).cast("long").alias("n"))


def q_extra_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other keys of a folder go into its description."""
    rows = J.verify(records(spark, sf_dir, _GOOD)).where("verified")
    one = rows.select("doc_id", F.explode("record.species").alias("s")).select("doc_id", F.posexplode("s.folders_and_sheets").alias("i", "f"))
    return one.select("doc_id", F.col("i").cast("long").alias("i"), F.col("f.description").alias("description"))


def q_flatten_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 to F3 in ``compat``: an empty list leaves an empty string."""
    rows = J.verify(records(spark, sf_dir, _GOOD)).where("verified")
    return J.flatten(rows, ["doc_id"])


def q_flatten_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 in ``safe``: an empty list leaves a null."""
    rows = J.verify(records(spark, sf_dir, _GOOD)).where("verified")
    return J.flatten(rows, ["doc_id"], mode="safe")


def q_joined_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, lists of plain values: a vector's values as one string of integers, multiplied as the single floats they are (with an integer, Spark would do it in double)."""
    vectors = table(spark, sf_dir, "embeddings").where("embedding is not null")
    return vectors.select("vec_id", J.joined_list(F.transform("embedding", lambda v: F.floor(v * F.lit(1000).cast("float")).cast("long"))).alias("joined"))


def q_json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a repair saves, among records with fences, trailing commas and open brackets."""
    text = F.concat(F.lit("Here it is:\n```json\n"), F.regexp_replace(F.expr(_GOOD), r"\]", ",]"), F.lit("\n```"))
    return J.verify(table(spark, sf_dir, "documents").select("doc_id", text.alias("json")), repair=True).select("doc_id", "verified", "error", F.to_json("record").alias("record"))


def q_conversation_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation for each whole text."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", R.flattened(R.conversations(CONFIG, F.col("text"))).alias("conversation"))


def q_conv_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as rows of roles and texts, joined in order."""
    turns = table(spark, sf_dir, "conversations")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")))), lambda x: F.concat(x["role"], F.lit(": "), x["text"]))
    return turns.groupBy("conv_id").agg(F.array_join(lines, "\n").alias("conversation"))


def q_taxa_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many conversations a text's windows make, and how long their texts are."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", R.taxa_prompt(S.stride_windows(F.col("text"))).alias("c"))
    size = F.aggregate("c", F.lit(0).cast("long"), lambda a, m: a + F.length(F.get(F.get(m, F.lit(1))["content"], F.lit(0))["text"]))
    return docs.select("doc_id", F.size("c").cast("long").alias("n"), size.alias("chars"))


def q_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: a dictionary's names found in whole texts."""
    names = table(spark, sf_dir, "part").select(F.initcap("p_name").alias("n")).select(F.concat(F.split_part("n", F.lit(" "), F.lit(1)), F.lit(" "), F.lower(F.split_part("n", F.lit(" "), F.lit(2)))).alias("name"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("Red widget and Small ring, Blue none. "), whole_text()).alias("text"))
    return B.dictionary_entities(names)(docs, "text").select("doc_id", F.array_join("entities", "|").alias("entities"))


def q_backbone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """parts' names against the backbone of the smallest part of each name and brand."""
    parts = table(spark, sf_dir, "part")
    backbone = parts.where("p_size > 25").groupBy(F.upper("p_name").alias("name"), F.upper("p_brand").alias("family")).agg(F.min("p_partkey").alias("taxon"))
    own = parts.select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("family"))
    return B.backbone_match(own, backbone)


_GOLD = """doc_id as row_no, case when doc_id % 17 = 0 then null else concat('Fam', doc_id % 37) end as family_name, case when doc_id % 19 = 0 then null else concat('Rosa n', doc_id % 211, '  x y') end as species_name,
  case when doc_id % 23 = 0 then null else {a} end as description"""
_PREDICTED = """doc_id as row_no, concat('fam', (doc_id + doc_id % 5) % 37) as family_name, concat('rosa N', (doc_id + doc_id % 3) % 211, '  x z') as species_name, {a} as description"""


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sided(spark, sf_dir, _GOLD)


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sided(spark, sf_dir, _PREDICTED)


def _sided(spark: SparkSession, sf_dir: str, frame: str) -> DataFrame:
    return E.normalized(spark.sql(f"select {frame.format(a=_WHOLE)} from {{docs}}", docs=table(spark, sf_dir, "documents")))


def q_species_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1, E3 to E6."""
    return _rounded(E.set_metrics(gold(spark, sf_dir), predicted(spark, sf_dir), "species_name"))


def q_pair_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 to E5, E7."""
    return _rounded(E.set_metrics(gold(spark, sf_dir), predicted(spark, sf_dir), "family_name", "species_name"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("tp", "fp", "fn", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


def q_first_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched pairs with each side's first description."""
    return E.matched_descriptions(gold(spark, sf_dir), predicted(spark, sf_dir))


def q_in_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9."""
    return E.in_both(gold(spark, sf_dir), predicted(spark, sf_dir), "family_name", "species_name")


def q_eval_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct values of each side."""
    sides = [(n, f(spark, sf_dir)) for n, f in (("gold", gold), ("predicted", predicted))]
    out = [d.agg(F.lit(n).alias("side"), F.count("*").alias("n"), F.countDistinct("species_name").alias("species"), F.countDistinct("family_name").alias("families")) for n, d in sides]
    return out[0].unionByName(out[1])


def q_eval_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five gold records in file order."""
    return E.ordered_head(gold(spark, sf_dir)).select("row_no", "family_name", "species_name", "description")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as a conversation, every third with an image before its text."""
    part = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    text, image = part("text", F.coalesce("text", F.lit(""))), part("image", F.lit(None).cast("string"))
    content = F.when(F.col("turn") % 3 == 0, F.array(image, text)).otherwise(F.array(text))
    messages = F.array(F.struct(F.coalesce("role", F.lit("user")).alias("role"), content.alias("content"))).cast(R.MESSAGES)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", R.chat_input(messages).alias("chat"))


def q_chat_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as prompts, with their images counted."""
    return chats(spark, sf_dir).select("conv_id", "turn", "chat.prompt", F.col("chat.images").cast("long").alias("images"))


def q_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in batches, by the stand-in for a model."""
    asked = chats(spark, sf_dir).select("conv_id", "turn", "chat.prompt")
    return B.generated(asked, "echo", max_new_tokens=3).select("conv_id", "turn", "answer")


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark's passages, each with a damaged copy."""
    return table(spark, sf_dir, "benchmark").select("item_id", F.coalesce("text", F.lit("")).alias("a")).withColumn("b", F.expr("replace(replace(a, 'an', 'm'), 'the ', '')"))


def q_cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E11."""
    return E.cer(passages(spark, sf_dir), "a", "b").withColumn("cer", F.round("cer", 6))


def q_wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E10."""
    return E.wer(passages(spark, sf_dir), "a", "b").withColumn("wer", F.round("wer", 6))


def q_rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E12."""
    return E.rouge_l(passages(spark, sf_dir), "a", "b")


def q_error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: how many records of each error go to quarantine."""
    return B.quarantine(J.verify(records(spark, sf_dir, _ANY))).groupBy("error").agg(F.count("*").alias("n"))


def q_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw catalogues to flat records, transcribed by rules."""
    blocks = S.text_blocks(S.structure(catalogues(spark, sf_dir), ["doc_id"], DIVISIONS), ["doc_id"])
    rows = B.accepted(B.transcribed(blocks, R.Config({"divisions": DIVISIONS})))
    flat = J.flatten(rows, ["doc_id", "div_ord", "fam_ord", "block", "division"])
    return flat.select("doc_id", *(F.col(c).cast("long").alias(c) for c in ("div_ord", "fam_ord", "block")), "division", "family_name", "species_name", F.col("number_of_folders").cast("long").alias("number_of_folders"), F.col("number_of_sheets").cast("long").alias("number_of_sheets"), "description")


_RAW = """'{"family_name": "VARCHAR", "species": [{"species_name": "VARCHAR", "number_of_folders": "VARCHAR", "number_of_sheets": "VARCHAR", "folders_and_sheets": ["JSON"]}]}'"""
_INT = r"(regexp_full_match({v}, '[+-]?\d+(\.0+)?') or {v} in ('true', 'false'))"
_PARSED = f"""
j as (select doc_id, {{json}} as j from documents),
p as (select doc_id, json_valid(j) as ok, json_transform(case when json_valid(j) then j else '{{{{}}}}' end, {_RAW.replace('{', '{{').replace('}', '}}')}) as r from j),
v as (select doc_id, r, ok, ok and r.family_name is not null and not list_bool_or(list_transform(coalesce(r.species, []), lambda s: s.species_name is null or not coalesce({_INT.format(v='s.number_of_folders')}, false) or not coalesce({_INT.format(v='s.number_of_sheets')}, false))) as v0 from p),
w as (select doc_id, r, coalesce(v0, ok and r.family_name is not null and len(coalesce(r.species, [])) = 0) as verified, doc_id as k from v)"""
_DESCRIPTION = """trim(coalesce(json_extract_string(f, '$.description'), '') || array_to_string(list_transform(list_filter(json_keys(f), lambda k: k <> 'description'), lambda k:
  ' ' || k || ': ' || case when json_extract_string(f, '$."' || k || '"') = 'true' then 'True' else json_extract_string(f, '$."' || k || '"') end), ''))"""
_FLAT = f"""
s as (select doc_id, r.family_name as family_name, len(r.species) as n, unnest(case when len(r.species) = 0 then [null] else r.species end) as s from w where verified),
t as (select doc_id, family_name, n, s.species_name as species_name, cast(s.number_of_folders as int) as number_of_folders, cast(s.number_of_sheets as int) as number_of_sheets, len(s.folders_and_sheets) as m,
  unnest(case when s is null or len(s.folders_and_sheets) = 0 then [null] else s.folders_and_sheets end) as f from s)"""
_GOLD_DUCK = f"""
g as (select row_no, lower(family_name) as family_name, array_to_string(string_split(lower(trim(species_name)), ' ')[1:3], ' ') as species_name, replace(lower({stripped(decomposed('description'))}), '\\', '') as description from (select {_GOLD.format(a=feature_sql())} from documents)),
p as (select row_no, lower(family_name) as family_name, array_to_string(string_split(lower(trim(species_name)), ' ')[1:3], ' ') as species_name, replace(lower({stripped(decomposed('description'))}), '\\', '') as description from (select {_PREDICTED.format(a=feature_sql())} from documents))"""
_SETS = """
a as (select distinct {c} from g where {n}), b as (select distinct {c} from p where {n}),
n as (select cast((select count(*) from (select * from a intersect select * from b)) as bigint) as tp, cast((select count(*) from (select * from b except select * from a)) as bigint) as fp, cast((select count(*) from (select * from a except select * from b)) as bigint) as fn),
m as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0 end as pr, case when tp + fn > 0 then tp / (tp + fn) else 0 end as re from n)
select tp, fp, fn, round(pr, 6) as precision, round(re, 6) as recall, round(case when pr + re > 0 then 2 * pr * re / (pr + re) else 0 end, 6) as f1 from m"""
_CHAT = "'<|' || coalesce(role, 'user') || '|>' || chr(10) || case when turn % 3 = 0 then '<|image|>' else '' end || coalesce(text, '') || chr(10)"
_PAIRS = """pairs as (select *, replace(replace(a, 'an', 'm'), 'the ', '') as b from (select item_id, coalesce(text, '') as a from benchmark))"""
_CONVERSATION = R.conversation(CONFIG, "\0")
_LITERAL = "\n".join(f"{m['role']}: " + "".join("<image>" if p["text"] is None else p["text"] for p in m["content"]) for m in _CONVERSATION).replace("'", "''").split("\0")

SQL = {
    "q_json_verify": f"with {_PARSED.format(json=_ANY)} select doc_id, verified, verified as clean, case when verified then r.family_name end as family_name, case when verified then len(coalesce(r.species, [])) end as n_species from w",
    "q_json_coerce": f"""with c as (select doc_id, {_COUNT.replace('"', '')} as v from documents)
select doc_id, cast(case when v = 'true' then 1 when regexp_full_match(v, '[+-]?\\d+(\\.0+)?') then cast(regexp_replace(v, '\\.0+$', '') as int) end as bigint) as n from c""",
    "q_extra_keys": f"with {_PARSED.format(json=_GOOD)}, {_FLAT} select doc_id, cast(row_number() over (partition by doc_id order by {_DESCRIPTION}) - 1 as bigint) as i, {_DESCRIPTION} as description from t where f is not null",
    "q_flatten_csv": f"""with {_PARSED.format(json=_GOOD)}, {_FLAT}
select doc_id, family_name, species_name, number_of_folders, number_of_sheets, case when f is not null then {_DESCRIPTION} end as description, case when n = 0 then '' end as species, case when n > 0 and m = 0 then '' end as folders_and_sheets from t""",
    "q_flatten_safe": f"""with {_PARSED.format(json=_GOOD)}, {_FLAT}
select doc_id, family_name, species_name, number_of_folders, number_of_sheets, case when f is not null then {_DESCRIPTION} end as description, cast(null as varchar) as species, cast(null as varchar) as folders_and_sheets from t""",
    "q_joined_lists": "select vec_id, array_to_string(list_transform(embedding, lambda v: cast(cast(floor(v * cast(1000 as float)) as bigint) as varchar)), ',') as joined from embeddings where embedding is not null",
    "q_conversation_build": f"select doc_id, '{"' || text || '".join(_LITERAL)}' as conversation from documents where text is not null",
    "q_conv_flatten": "select conv_id, string_agg(role || ': ' || coalesce(text, ''), chr(10) order by turn, role, text) as conversation from conversations group by conv_id",
    "q_taxa_windows": "with w as (select doc_id, text, unnest(range(0, greatest(length(text), 1), 2000)) as p from documents where text is not null) select doc_id, count(*) filter (text <> '') as n, cast(coalesce(sum(length(substr(text, p + 1, 4000))), 0) as bigint) as chars from w group by doc_id",
    "q_entities": f"""
with d as (select distinct upper(p_name[1]) || p_name[2:] as name from part where p_name like '% %'),
t as (select doc_id, 'Red widget and Small ring, Blue none. ' || {feature_sql()} as t from documents),
m as (select distinct doc_id, unnest(regexp_extract_all(t, '\\b[A-Z][a-z]+ [a-z]+')) as name from t)
select t.doc_id, coalesce(string_agg(d.name, '|' order by d.name), '') as entities from t left join m on m.doc_id = t.doc_id left join d on d.name = m.name group by t.doc_id""",
    "q_backbone_lookup": """
with b as (select lower(p_name) as n, lower(p_brand) as f, min(p_partkey) as taxon from part where p_size > 25 group by 1, 2)
select p_partkey, p_name as name, p_brand as family, taxon from part left join b on b.n = lower(p_name) and b.f = lower(p_brand) where len(string_split(p_name, ' ')) > 1""",
    "q_species_prf": f"with {_GOLD_DUCK}, {_SETS.format(c='species_name', n='species_name is not null')}",
    "q_pair_prf": f"with {_GOLD_DUCK}, {_SETS.format(c='family_name, species_name', n='family_name is not null and species_name is not null')}",
    "q_first_desc": f"""with {_GOLD_DUCK},
a as (select family_name, species_name, arg_min({{'d': description}}, row_no).d as d from g where family_name is not null and species_name is not null group by all),
b as (select family_name, species_name, arg_min({{'d': description}}, row_no).d as d from p group by all)
select family_name, species_name, a.d as gold_description, b.d as predicted_description from a join b using (family_name, species_name) where a.d is not null and b.d is not null""",
    "q_in_both": f"with {_GOLD_DUCK} select family_name, species_name from g where family_name is not null and species_name is not null intersect select family_name, species_name from p",
    "q_eval_counts": f"with {_GOLD_DUCK} select 'gold' as side, count(*) as n, count(distinct species_name) as species, count(distinct family_name) as families from g union all select 'predicted', count(*), count(distinct species_name), count(distinct family_name) from p",
    "q_eval_head": f"with {_GOLD_DUCK} select * from g order by row_no limit 5",
    "q_chat_inputs": f"select conv_id, turn, {_CHAT} || '<|assistant|>' || chr(10) as prompt, cast(case when turn % 3 = 0 then 1 else 0 end as bigint) as images from conversations",
    "q_generated": f"with w as (select conv_id, turn, list_filter(regexp_split_to_array({_CHAT}, '\\s+'), lambda v: v <> '') as w from conversations) select conv_id, turn, array_to_string(w[-3:], ' ') as answer from w",
    "q_cer": f"with {_PAIRS}, n as (select cast(sum(levenshtein(a, b)) as bigint) as edits, cast(sum(length(a)) as bigint) as length from pairs) select edits, length, round(edits / length, 6) as cer from n",
    # A row of the table of edits from the row before and the next word's mismatches with all words of a.
    "q_wer": f"""
with {_PAIRS}, w as (select list_filter(regexp_split_to_array(a, '\\s+'), lambda v: v <> '') as a, list_filter(regexp_split_to_array(b, '\\s+'), lambda v: v <> '') as b from pairs),
m as (select len(a) as n, list_prepend(cast(range(0, len(a) + 1) as bigint[]), list_transform(b, lambda y: list_transform(a, lambda x: cast(x <> y as bigint)))) as m from w),
d as (select n, list_reduce(m, lambda d, x: list_transform(range(0, len(d)), lambda j: j + list_min(list_transform(range(0, j + 1), lambda k: case when k = 0 then d[1] + 1 else least(d[k + 1] + 1, d[k] + x[k]) - k end)))) as d from m),
t as (select cast(sum(d[n + 1]) as bigint) as edits, cast(sum(n) as bigint) as words from d)
select edits, words, round(edits / words, 6) as wer from t""",
    "q_error_log": f"with {_PARSED.format(json=_ANY)}, o as (select w.*, p.ok from w join p using (doc_id)) select case when not ok then 'not JSON' else 'required field missing or of another type' end as error, count(*) as n from o where not verified group by 1",
    "q_end_to_end": f"""
with b as ({_SEGMENTS['q_text_blocks'].strip()}),
r as (select doc_id, div_ord, fam_ord, block, division, family, string_split(content, chr(10) || chr(10)) as r from b),
u as (select doc_id, div_ord, fam_ord, block, division, family, unnest(list_transform(r, lambda x: list_filter(string_split(x, chr(10)), lambda y: trim(y) <> ''))) as l from r),
e as (select *, unnest(case when len(l) < 2 then [null] else l[2:] end) as description from u where len(l) > 0
  union all by name select doc_id, div_ord, fam_ord, block, division, family from r where regexp_full_match(array_to_string(r, ''), '\\s*'))
select doc_id, div_ord, fam_ord, block, division, family as family_name, l[1] as species_name, len(l) - 1 as number_of_folders, case when l is not null then cast(0 as bigint) end as number_of_sheets, description from e""",
}

QUERIES = {
    f.__name__: f
    for f in (
        q_json_verify, q_json_coerce, q_extra_keys, q_flatten_csv, q_flatten_safe, q_joined_lists, q_json_repair, q_conversation_build, q_conv_flatten, q_taxa_windows, q_entities, q_backbone_lookup,
        q_species_prf, q_pair_prf, q_first_desc, q_in_both, q_eval_counts, q_eval_head, q_chat_inputs, q_generated, q_cer, q_wer, q_rouge_l, q_error_log, q_end_to_end,
    )
}
