"""Scoring of predicted against gold records: set metrics and edit distances."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Types

from ..functions import text as T
from ..functions.porter import stem


def normalized(df: DataFrame, family: str = "family_name", species: str = "species_name", description: str = "description") -> DataFrame:
    """T28."""
    return df.withColumns({family: T.eval_normal(F.col(family)), species: T.eval_normal(F.col(species), species=True), description: T.eval_normal(F.col(description))})


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows without a null."""
    return df.select(*columns).dropna(how="any").distinct()


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def set_metrics(gold: DataFrame, predicted: DataFrame, *columns: str) -> DataFrame:
    """One row (tp, fp, fn, precision, recall, f1). One aggregation over the union of both sides; no join."""
    sides = gold.select(*columns).dropna().withColumn("g", F.lit(1)).withColumn("p", F.lit(0)).unionByName(predicted.select(*columns).dropna().withColumn("g", F.lit(0)).withColumn("p", F.lit(1)))
    each = sides.groupBy(*columns).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    n = each.agg(*(F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(k) for k, c in (("tp", F.col("g") * F.col("p")), ("fp", (1 - F.col("g")) * F.col("p")), ("fn", F.col("g") * (1 - F.col("p"))))))
    n = n.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return n.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def first_descriptions(df: DataFrame, row_no: str = "row_no") -> DataFrame:
    """E8, one side: the first row's description of each pair, null or not."""
    return df.dropna(subset=["family_name", "species_name"]).groupBy("family_name", "species_name").agg(F.min(F.struct(F.col(row_no), F.col("description"))).getField("description").alias("description"))


def matched_descriptions(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """(family_name, species_name, gold_description, predicted_description) where neither is null."""
    a = first_descriptions(gold).withColumnRenamed("description", "gold_description")
    b = first_descriptions(predicted).withColumnRenamed("description", "predicted_description")
    return a.join(b, ["family_name", "species_name"]).dropna()


def in_both(gold: DataFrame, predicted: DataFrame, *columns: str) -> DataFrame:
    """E9."""
    return distinct_values(gold, *columns).join(distinct_values(predicted, *columns), list(columns), "left_semi")


def ordered_head(df: DataFrame, n: int = 5, row_no: str = "row_no") -> DataFrame:
    """The first rows in file order; each task keeps ``n`` and no more is moved."""
    return df.orderBy(row_no).limit(n)


def character_errors(reference: Column, hypothesis: Column) -> Column:
    return F.levenshtein(reference, hypothesis)


def cer(pairs: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """(edits, length, cer) over all pairs."""
    n = pairs.agg(F.sum(F.levenshtein(F.col(reference), F.col(hypothesis)).cast("long")).alias("edits"), F.sum(F.length(reference).cast("long")).alias("length"))
    return n.withColumn("cer", ratio(F.col("edits"), F.col("length")))


def words_as_characters(reference: Column, hypothesis: Column) -> tuple[Column, Column]:
    """Two strings with a character for each word, the same for equal words, so that edits are of words. Each pair may hold 50 000 distinct words."""
    split = lambda c: F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")
    vocabulary = F.array_distinct(F.concat(split(reference), split(hypothesis)))

    def character(w: Column) -> Column:
        k = F.array_position(vocabulary, w).cast("int")
        code = F.when(k < 0xD000, k + 0x20).otherwise(k + 0x20 + 0x1000)  # past the surrogates
        return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")

    return tuple(F.array_join(F.transform(split(c), character), "") for c in (reference, hypothesis))


def wer(pairs: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """(edits, words, wer) over all pairs."""
    a, b = words_as_characters(F.col(reference), F.col(hypothesis))
    own = pairs.select(a.alias("_reference"), b.alias("_hypothesis"))  # names of no column, which an expression beside them could mean
    n = own.agg(F.sum(F.levenshtein("_reference", "_hypothesis").cast("long")).alias("edits"), F.sum(F.length("_reference").cast("long")).alias("words"))
    return n.withColumn("wer", ratio(F.col("edits"), F.col("words")))


def lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with one bitset row."""
    at: dict[str, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for w in b:
        m = row & at.get(w, 0)
        row = ((row + m) | (row - m)) & full
    return len(a) - row.bit_count()


def rouge_l_scores(reference: str, hypothesis: str) -> tuple[float, float, float]:
    """Over runs of letters and digits of ASCII; those longer than three are stemmed."""
    a, b = ([stem(w) if len(w) > 3 else w for w in re.findall(r"[a-z0-9]+", t.lower())] for t in (reference, hypothesis))
    if not a or not b:
        return 0.0, 0.0, 0.0
    n = lcs(a, b)
    p, r = n / len(b), n / len(a)
    return p, r, 2 * p * r / (p + r) if n else 0.0


_SCORES = Types.StructType([Types.StructField(n, Types.DoubleType()) for n in "prf"])


@F.pandas_udf(_SCORES)
def rouge_l_each(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for a, b in batches:
        yield pd.DataFrame([rouge_l_scores(x or "", y or "") for x, y in zip(a, b)], columns=["p", "r", "f"])


def rouge_l(pairs: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """The means over pairs; nulls for no pairs."""
    return pairs.select(rouge_l_each(F.col(reference), F.col(hypothesis)).alias("s")).agg(F.avg("s.p").alias("precision"), F.avg("s.r").alias("recall"), F.avg("s.f").alias("f1"))
