"""JSON: repair, validation against the catalogue schema, lax coercion, flattening."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Types

FOLDER = "map<string,string>"
RAW = f"struct<family_name:string,species:array<struct<species_name:string,number_of_folders:string,number_of_sheets:string,folders_and_sheets:array<{FOLDER}>>>>"
CATALOGUE = "struct<family_name:string,species:array<struct<species_name:string,number_of_folders:int,number_of_sheets:int,folders_and_sheets:array<struct<description:string>>>>>"
TAXA = "struct<taxa:array<struct<scientific_name:string>>>"  #: X11
SCHEMAS = {"default": CATALOGUE, "taxa": TAXA}


def get_schema(name: str) -> str:
    """X7."""
    if name not in SCHEMAS:
        raise ImportError(f"no schema named {name}")
    return SCHEMAS[name]


def lax_int(value: Column) -> Column:
    """Integers, and whole numbers or booleans written otherwise; null for anything else."""
    v = F.trim(value)
    whole = F.when(v.rlike(r"^[+-]?\d+(\.0+)?$"), F.expr("null")).cast("int")
    number = F.regexp_replace(v, r"\.0+$", "").try_cast("int")
    return F.when(v == "true", 1).when(v == "false", 0).when(v.rlike(r"^[+-]?\d+(?:\.0+)?$"), number).otherwise(whole)


def folder_description(folder: Column) -> Column:
    """The description, and all other keys as ``key: value`` in order."""
    extra = F.filter(F.map_entries(folder), lambda e: e["key"] != "description")
    parts = F.transform(extra, lambda e: F.concat(e["key"], F.lit(": "), F.when(e["value"].isNull(), "None").when(e["value"] == "true", "True").when(e["value"] == "false", "False").otherwise(e["value"])))
    own = F.coalesce(F.element_at(folder, "description"), F.lit(""))
    return F.regexp_replace(F.when(F.size(parts) > 0, F.concat(own, F.lit(" "), F.array_join(parts, " "))).otherwise(own), r"(?U)^\s+|\s+\z", "")


def parse(text: Column) -> Column:
    """J1, syntax: the raw catalogue with counts as strings; null where it is no JSON object."""
    return F.from_json(text, RAW, {"mode": "PERMISSIVE"})


def is_json(text: Column) -> Column:
    """Whether the text is JSON at all."""
    return F.coalesce(F.try_parse_json(text).isNotNull(), F.lit(False))


def missing_fields(raw: Column) -> Column:
    """Whether a required field is absent or no acceptable value."""
    bad = lambda s: s["species_name"].isNull() | lax_int(s["number_of_folders"]).isNull() | lax_int(s["number_of_sheets"]).isNull()
    return raw.isNull() | raw["family_name"].isNull() | F.coalesce(F.exists(raw["species"], bad), F.lit(False))


def catalogue(raw: Column) -> Column:
    """The validated record, of type ``CATALOGUE``."""
    species = F.transform(
        F.coalesce(raw["species"], F.array().cast("array<struct<species_name:string,number_of_folders:string,number_of_sheets:string,folders_and_sheets:array<map<string,string>>>>")),
        lambda s: F.struct(
            s["species_name"].alias("species_name"),
            lax_int(s["number_of_folders"]).alias("number_of_folders"),
            lax_int(s["number_of_sheets"]).alias("number_of_sheets"),
            F.transform(F.coalesce(s["folders_and_sheets"], F.array().cast("array<map<string,string>>")), lambda f: F.struct(folder_description(f).alias("description"))).alias("folders_and_sheets"),
        ),
    )
    return F.struct(raw["family_name"].alias("family_name"), species.alias("species"))


def verify(df: DataFrame, text: str = "json", out: str = "record", repair: bool = False) -> DataFrame:
    """Adds ``verified``, ``out`` and ``error`` (null where verified)."""
    source = repaired(F.col(text)) if repair else F.col(text)
    rows = df.withColumn("_text", source).withColumn("_raw", F.when(is_json(F.col("_text")), parse(F.col("_text"))))
    bad = missing_fields(F.col("_raw"))
    error = F.when(~is_json(F.col("_text")), "not JSON").when(bad, "required field missing or of another type")
    return rows.withColumns({"verified": error.isNull(), out: F.when(error.isNull(), catalogue(F.col("_raw"))), "error": error}).drop("_raw", "_text")


def repair_text(text: str) -> str:
    """J2, a stated subset: fences and prose around the object, trailing commas, Python literals, cut-off strings, and brackets left open."""
    t = re.sub(r"```(?:json)?", "", text)
    start = min((i for i in (t.find("{"), t.find("[")) if i >= 0), default=-1)
    if start < 0:
        return text
    out, stack, quoted, escaped = [], [], False, False
    for ch in t[start:]:
        out.append(ch)
        if quoted:
            escaped, quoted = (ch == "\\" and not escaped), not (ch == '"' and not escaped)
            continue
        if ch == '"':
            quoted, escaped = True, False
        elif ch in "{[":
            stack.append("}" if ch == "{" else "]")
        elif ch in "}]":
            if not stack:
                out.pop()
                break
            if stack[-1] != ch:  # the inner one was left open
                out[-1:] = [stack.pop(), ch]
            stack.pop()
            if not stack:
                break
    whole = "".join(out) + '"' * quoted
    whole = re.sub(r"[,:]\s*$", "", whole) + "".join(reversed(stack))
    whole = re.sub(r",(\s*[}\]])", r"\1", whole)
    whole = re.sub(r"(?<=[:\[,\s])(True|False|None)(?=[\s,}\]])", lambda m: {"True": "true", "False": "false", "None": "null"}[m[1]], whole)
    try:
        json.loads(whole)
    except ValueError:
        return text
    return whole


@F.pandas_udf(Types.StringType())
def repaired(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """J2 over a column."""
    for s in batches:
        yield s.map(lambda t: None if t is None else repair_text(t))


def add_division(divisions: Column) -> Column:
    """a map of division to records as (division, data) entries."""
    return F.transform(F.map_entries(divisions), lambda e: F.struct(e["key"].alias("division"), e["value"].alias("data")))


def flatten(df: DataFrame, keys: list[str], record: str = "record", mode: str = "compat") -> DataFrame:
    """a row for each folder. A list that is empty leaves its parent's row, with ``""`` in a column of the list's name in ``compat`` and null in ``safe``."""
    empty = F.lit("") if mode == "compat" else F.lit(None).cast("string")
    r = df.select(*keys, F.col(record)["family_name"].alias("family_name"), F.size(F.col(record)["species"]).alias("_n"), F.explode_outer(F.col(record)["species"]).alias("s"))
    r = r.select(*keys, "family_name", "_n", F.col("s.species_name").alias("species_name"), F.col("s.number_of_folders").alias("number_of_folders"), F.col("s.number_of_sheets").alias("number_of_sheets"), F.size("s.folders_and_sheets").alias("_m"), F.explode_outer("s.folders_and_sheets").alias("f"))
    return r.select(*keys, "family_name", "species_name", "number_of_folders", "number_of_sheets", F.col("f.description").alias("description"), F.when(F.col("_n") <= 0, empty).alias("species"), F.when((F.col("_n") > 0) & (F.col("_m") <= 0), empty).alias("folders_and_sheets"))


def joined_list(values: Column) -> Column:
    """F2 for a list of plain values."""
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")
