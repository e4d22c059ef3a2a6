"""Chunks: packing, overlap, tokens with spans, fuzzy merging."""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from itertools import batched

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Types

from ..functions.text import strip


def numbered_items(df: DataFrame, keep: list[str], items: Column, number: str, item: str) -> DataFrame:
    """(keep, number, item): a row for each of ``items``. The outer generator, as the inner one makes Spark work out its whole input once more, to filter out empty ones."""
    return df.select(*keep, F.posexplode_outer(items).alias(number, item)).where(F.col(number).isNotNull())


def group_major(chunks: Column, size: int = 1000, mode: str = "compat") -> Column:
    """Chunks joined greedily by a blank line while they fit. ``compat`` starts with an empty chunk where the first is too long."""
    start = F.struct(F.lit("").alias("cur"), F.array().cast("array<string>").alias("done"))

    def step(a: Column, c: Column) -> Column:
        over = F.length(a["cur"]) + F.length(c) > size
        return F.when(over, F.struct(strip(c).alias("cur"), F.array_append(a["done"], strip(a["cur"])).alias("done"))).otherwise(F.struct(F.concat(a["cur"], F.lit("\n\n"), strip(c)).alias("cur"), a["done"].alias("done")))

    out = F.aggregate(chunks, start, step, lambda a: F.when(a["cur"] != "", F.array_append(a["done"], strip(a["cur"]))).otherwise(a["done"]))
    return F.filter(out, lambda x: x != "") if mode == "safe" else out


def pack_paragraphs(paragraphs: Column, size: int = 2000, mode: str = "compat") -> Column:
    """Paragraphs packed greedily, joined by line feeds that do not count. ``compat`` loses the paragraph that overflows; ``safe`` starts the next chunk with it."""
    kind = "struct<cur:array<string>,n:int,done:array<string>>"
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("cur"), F.lit(0).alias("n"), none.alias("done")).cast(kind)

    def step(a: Column, p: Column) -> Column:
        fits = a["n"] + F.length(p) <= size
        done = F.when(F.size(a["cur"]) > 0, F.array_append(a["done"], F.array_join(a["cur"], "\n"))).otherwise(a["done"])
        rest = F.struct(F.array(p).alias("cur"), F.length(p).alias("n"), done.alias("done")) if mode == "safe" else F.struct(none.alias("cur"), F.lit(0).alias("n"), done.alias("done"))
        return F.when(fits, F.struct(F.array_append(a["cur"], p).alias("cur"), (a["n"] + F.length(p)).alias("n"), a["done"].alias("done")).cast(kind)).otherwise(rest.cast(kind))

    return F.aggregate(paragraphs, start, step, lambda a: F.when(F.size(a["cur"]) > 0, F.array_append(a["done"], F.array_join(a["cur"], "\n"))).otherwise(a["done"]))


def add_overlap(chunks: Column, words: int = 100) -> Column:
    """Each chunk but the first is preceded by the last words of the one before, as already extended."""
    start = F.array().cast("array<string>")

    def step(a: Column, c: Column) -> Column:
        w = F.filter(F.split(F.element_at(a, -1), r"(?U)\s+"), lambda x: x != "")
        tail = F.array_join(F.slice(w, F.greatest(F.lit(1), F.size(w) - words + 1), F.lit(words)), " ")
        return F.when(F.size(a) == 0, F.array(c)).otherwise(F.array_append(a, F.concat(tail, F.lit(" "), c)))

    return F.aggregate(chunks, start, step)


_PUNCTUATION = r"[!-/:-@\[-`{-~]"


def clean_tokens(text: Column) -> Column:
    """C4, the tokens: runs of other than white space, without ASCII punctuation at their ends."""
    t = F.transform(F.regexp_extract_all(text, F.lit(r"(?U)\S+"), 0), lambda x: F.regexp_replace(x, rf"^{_PUNCTUATION}+|{_PUNCTUATION}+\z", ""))
    return F.filter(t, lambda x: x != "")


def each_span(text: str) -> Iterator[tuple[str, int, int]]:
    return ((t, m.start(), m.end()) for m in re.finditer(r"\S+", text) if (t := m.group().strip(string.punctuation)))


def spans_of(text: str) -> list[tuple[str, int, int]]:
    return list(each_span(text))


_SPANS = Types.ArrayType(Types.StructType([Types.StructField("tok", Types.StringType()), Types.StructField("s", Types.IntegerType()), Types.StructField("e", Types.IntegerType())]))


@F.arrow_udf(_SPANS)
def tokens_and_spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """C4, with the span of each run as it stands. For rows of tokens ``token_rows`` holds less."""
    kinds = {"tok": pa.string(), "s": pa.int32(), "e": pa.int32()}
    none = pa.array([], pa.struct(list(kinds.items())))
    for texts in batches:
        parts, ends = [none], [0]
        for t in texts:  # a text's tokens are objects of Python's, a batch's are not
            columns = list(zip(*each_span(t.as_py() or ""))) or [()] * 3
            parts.append(pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds)))
            ends.append(ends[-1] + len(parts[-1]))
        yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(parts), mask=texts.is_null())


TOKENS = 1 << 16  #: rows that ``token_rows`` holds


def token_rows(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """C4 as rows (keep, i, tok, s, e), put out as they are found: no more than ``TOKENS`` are held, be they of many texts or of a part of one."""
    schema = Types.StructType([*df.select(*keep).schema.fields, Types.StructField("i", Types.LongType()), Types.StructField("tok", Types.StringType()), Types.StructField("s", Types.LongType()), Types.StructField("e", Types.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = ((row, i, *span) for row, t in enumerate(b.column(len(keep))) for i, span in enumerate(each_span(t.as_py() or "")))
            for some in batched(found, TOKENS):
                row, i, tok, s, e = zip(*some)
                at = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(len(keep))), pa.array(i, pa.int64()), pa.array(tok, pa.string()), pa.array(s, pa.int64()), pa.array(e, pa.int64())], schema.names)

    return df.select(*keep, text).mapInArrow(run, schema)


def partial_ratio(a: str, b: str) -> float:
    """The best ratio (0 to 100) of the shorter string against windows of the longer; approximates the usual library's."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 0.0
    m = SequenceMatcher(None, short, long, autojunk=False)
    best = 0.0
    for i, j, _ in m.get_matching_blocks():
        at = max(0, j - i)
        best = max(best, SequenceMatcher(None, short, long[at : at + len(short)], autojunk=False).ratio())
        if best > 0.995:
            return 100.0
    return round(100 * best, 6)


def merge_two(a: str, b: str, overlap: int = 100, window: int = 10, threshold: float = 90, ratio: Callable[[str, str], float] = partial_ratio) -> str:
    """The largest window whose tail of ``a`` and head of ``b`` are most alike; from the threshold on, ``b`` goes on behind it."""
    left, right = [t for t, *_ in spans_of(a)], spans_of(b)
    best, at = 0.0, 0
    for w in range(int(overlap * 1.2) + window, 0, -1):
        r = ratio(" ".join(left[-w:]), " ".join(t for t, *_ in right[: w + 1]))
        if r > best:
            best, at = r, w
        if best >= 100:  # nothing smaller can beat it
            break
    if best < threshold:
        return f"{a}\n\n{b}"
    return f"{a}\n\n{b[right[at][1] if at < len(right) else len(b):]}"


def merge_all(overlap: int = 100, window: int = 10, threshold: float = 90, ratio: Callable[[str, str], float] = partial_ratio):
    """A function of an array column, which merges its chunks from the left. An empty array is an error."""

    @F.pandas_udf("string")
    def merged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = []
            for chunks in s:
                if chunks is None:
                    out.append(None)
                    continue
                if not len(chunks):
                    raise ValueError("no chunks to merge")
                whole = chunks[0]
                for c in list(chunks)[1:]:
                    whole = merge_two(whole, c, overlap, window, threshold, ratio)
                out.append(whole)
            yield pd.Series(out, dtype=object)

    return merged


def chunk_and_clean(text: Column, clean: Callable[[Column], Column] = lambda c: c, size: int = 2000, overlap: int = 100) -> Column:
    """Packed with overlap, cleaned, and merged again."""
    from .segment import paragraphs

    chunks = add_overlap(pack_paragraphs(paragraphs(text), size), overlap)
    return merge_all(overlap)(F.transform(chunks, clean))


def batch_number(position: Column, size: int = 10) -> Column:
    """C8."""
    return F.floor(position / size).cast("long")
