"""Segmentation: one text into divisions, families, records and blocks.

Each operator keeps the caller's key columns and adds ordinals, so that rows
can be put in order again without a global sort. ``mode="compat"`` keeps the
pairing of non-empty fragments as it is; ``"safe"`` loses no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T
from .chunk import group_major, numbered_items

NO_DIVISION = "NO DIVISION FOUND"
NO_FAMILY = "No family found"


def division_pattern(divisions: list[str]) -> str:
    """G1."""
    return rf"(?iu)(?:\d+\.?\s+)?({'|'.join(map(T.quoted, divisions))})\.?"


def with_captures(text: Column, pattern: str) -> Column:
    """The pieces between matches and the first groups of the matches, in turn."""
    return F.flatten(F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 1), lambda a, b: F.array_compact(F.array(a, b))))


def division_pairs(text: Column, pattern: str, mode: str = "compat") -> Column:
    """(division, content) pairs of a text, in order."""
    if mode == "safe":  # paired by position: an empty content shifts nothing, and what precedes is kept
        parts, names = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 1)
        own = F.zip_with(names, F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda d, t: F.struct(d.alias("div"), F.coalesce(t, F.lit("")).alias("content")))
        before = F.when(T.strip(F.get(parts, F.lit(0))) != "", F.array(F.struct(F.lit(NO_DIVISION).alias("div"), F.get(parts, F.lit(0)).alias("content")))).otherwise(F.slice(own, 1, 0))
        return F.concat(before, own)
    return paired(F.filter(with_captures(text, pattern), P.kept_fragment))


def paired(kept: Column) -> Column:
    """The first and second, third and fourth fragment and so on; a last one without a partner is left out."""
    both = F.zip_with(kept, F.slice(kept, 2, F.greatest(F.size(kept) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("div"), b.alias("content")))
    return F.filter(both, lambda p, i: (i % 2 == 0) & p["content"].isNotNull())


def split_by_divisions(df: DataFrame, keys: list[str], divisions: list[str], text: str = "text", mode: str = "compat") -> DataFrame:
    """(keys, div_ord, division, text). Fragments that are no headings go on with the division before; in ``compat`` those without one are left out (``orphans`` has them)."""
    carried = _carried(df, keys, divisions, text, mode)
    rows = carried.where("division is not null") if mode == "compat" else carried.withColumn("division", F.coalesce("division", F.lit(NO_DIVISION)))
    return rows.groupBy(*keys, "division").agg(F.min("ord").alias("div_ord"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "part"))), lambda x: x["part"]), "").alias("text")).select(*keys, "div_ord", "division", "text")


def orphans(df: DataFrame, keys: list[str], divisions: list[str], text: str = "text") -> DataFrame:
    """Fragments before any division heading, which ``compat`` has no place for."""
    return _carried(df, keys, divisions, text, "compat").where("division is null").select(*keys, "ord", "part")


def _carried(df: DataFrame, keys: list[str], divisions: list[str], text: str, mode: str) -> DataFrame:
    pattern = division_pattern(divisions)
    if mode == "compat":  # a column of its own, so that patterns run once over a text
        both = df.select(*keys, F.filter(with_captures(F.col(text), pattern), P.kept_fragment).alias("_kept")).select(*keys, paired(F.col("_kept")).alias("_pairs"))
    else:
        both = df.select(*keys, division_pairs(F.col(text), pattern, mode).alias("_pairs"))
    pairs = numbered_items(both, keys, F.col("_pairs"), "ord", "p").select(*keys, "ord", F.col("p.div").alias("div"), F.col("p.content").alias("content"))
    heading = P.is_heading(F.col("div"))
    so_far = Window.partitionBy(*keys).orderBy("ord")
    name = F.upper(F.col("div")) if mode == "safe" else F.col("div")
    return pairs.select(*keys, "ord", F.last(F.when(heading, name), ignorenulls=True).over(so_far).alias("division"), F.when(heading, F.col("content")).otherwise(F.concat("div", "content")).alias("part"))


def family_parts(text: Column, mode: str = "compat") -> Column:
    """(family, text) of each family heading of a text; one of ``NO_FAMILY`` where there is none."""
    names, parts = F.regexp_extract_all(text, F.lit(T.FAMILY), 1), F.split(text, T.FAMILY, -1)
    found = F.zip_with(names, F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda f, t: F.struct(f.alias("family"), t.alias("text")))
    none = F.array(F.struct(F.lit(NO_FAMILY).alias("family"), T.strip(text).alias("text")))
    if mode == "safe":
        first = F.get(parts, F.lit(0))
        found = F.when(T.strip(first) != "", F.concat(F.array(F.struct(F.lit(None).cast("string").alias("family"), first.alias("text"))), found)).otherwise(found)
    return F.when(F.size(names) == 0, none).otherwise(found)


def split_by_families(df: DataFrame, keys: list[str], text: str = "text", mode: str = "compat") -> DataFrame:
    """(keys, fam_ord, family, text). A projection: no shuffle."""
    return numbered_items(df, keys, family_parts(F.col(text), mode), "fam_ord", "p").select(*keys, "fam_ord", F.col("p.family").alias("family"), F.col("p.text").alias("text"))


#: A line feed before a line that starts a record by its shape, as ``P.starts_shaped_record`` tests lines; blanks end with the line.
_BEFORE_SHAPED = "\n(?=" + P.RECORD_INDEX.removeprefix("^").replace(r"\s", r"[ \t\x0B\f\r]") + r"[A-Z][a-z]+ [a-z]+)"


def shaped_records(text: Column) -> Column:
    """G4 within a row: the records of a text, by the species shape, as an array."""

    def record(part: Column) -> Column:
        return F.array_join(F.filter(F.transform(F.split(part, "\n"), T.strip), lambda x: x != ""), "\n")

    return F.filter(F.transform(F.split(text, _BEFORE_SHAPED, -1), record), lambda x: x != "")


def split_records(df: DataFrame, keys: list[str], text: str = "text", entities: str | None = None) -> DataFrame:
    """(keys, rec, record). A record starts at each line that starts with an entity of the row's array ``entities``, or without it at each species-shaped line; lines before the first are a record too."""
    head = P.starts_record(F.col("line"), F.filter(F.col(entities), P.species_shaped)) if entities else P.starts_shaped_record(F.col("line"))
    lines = numbered_items(df, [*keys, *([entities] if entities else [])], F.split(text, "\n"), "line_no", "line").where(P.not_blank(F.col("line")))
    so_far = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.select(*keys, "line_no", T.strip(F.col("line")).alias("line"), head.cast("int").alias("head"))
    numbered = marked.withColumn("rec", F.sum("head").over(so_far))
    return numbered.groupBy(*keys, "rec").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("record"))


#: A species with its index, rank, author and note.
SPECIES = r"((?:\d+\.\s)?[A-Z][a-z\-]+(?:\s[a-z\-]+)?(?:\s(?:var\.|subsp\.|f\.)\s[a-z\-]+)?(?:\s[A-Z][a-z\-]+)?(?:\s\([\w\s]+\))?)"


def species_mentions(text: Column) -> Column:
    """G5."""
    return F.regexp_extract_all(text, F.lit(SPECIES), 1)


def structure(df: DataFrame, keys: list[str], divisions: list[str], text: str = "text", entities=None, max_chunk: int = 3000, mode: str = "compat") -> DataFrame:
    """(keys, div_ord, division, fam_ord, family, species): cleaned, split and packed. ``entities``: a backend's function of a DataFrame and its text column, which adds an array column ``entities``."""
    clean = df.select(*keys, T.preprocess(F.col(text), divisions[0], mode).alias("text"))
    by_division = split_by_divisions(clean, keys, divisions, mode=mode).withColumn("division", T.strip(F.col("division")))
    own = [*keys, "div_ord", "division"]
    by_family = split_by_families(by_division, own, mode=mode)
    more = [*own, "fam_ord", "family"]
    if not entities:  # a projection: lines are neither moved nor sorted
        packed = by_family.where(P.not_blank(F.col("text"))).select(*more, shaped_records(F.col("text")).alias("_records"))
        return packed.select(*more, group_major(F.col("_records"), max_chunk, mode).alias("species"))
    records = split_records(entities(by_family, "text"), more, entities="entities")
    packed = records.groupBy(*more).agg(F.transform(F.array_sort(F.collect_list(F.struct("rec", "record"))), lambda x: x["record"]).alias("_records"))
    return packed.select(*more, group_major(F.col("_records"), max_chunk, mode).alias("species"))


def text_blocks(struct: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, div_ord, fam_ord, block, division, family, content)."""
    return numbered_items(struct, [*keys, "div_ord", "fam_ord", "division", "family"], F.col("species"), "block", "content").select(*keys, "div_ord", "fam_ord", "block", "division", "family", "content")


def lines(text: Column) -> Column:
    """Plain lines."""
    return F.split(text, "\n")


def paragraphs(text: Column) -> Column:
    """Lines without leading white space."""
    return F.split(text, r"(?U)\n\s*")


def stride_windows(text: Column, size: int = 4000, step: int = 2000) -> Column:
    """Overlapping windows, the last ones short; an empty text has none."""
    n = F.length(text)
    none = F.array().cast("array<string>")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1, F.lit(step)), lambda i: F.substring(text, i + 1, F.lit(size)))).otherwise(none)


def trial_prefix(text: Column, size: int = 5000) -> Column:
    """What a trial run reads."""
    return F.substring(text, 1, size)
