"""Models behind interfaces: recognition, layout, entities, transcription.

A backend is made by name on the worker, once for each Python process, so that
whatever it loads is loaded once and never pickled. The defaults are rules that
need no model; others are added with ``register``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonx as J
from ..functions import predicates as P
from ..functions import prompts as R
from .chunk import numbered_items


class Recognizer(Protocol):
    """M2: an image's text."""

    def __call__(self, image: bytes) -> str: ...


class Transcriber(Protocol):
    """M6: the answer to a conversation."""

    def __call__(self, messages: list[dict]) -> str: ...


class Generator(Protocol):
    """What follows each prompt of a batch, which may repeat the prompt in front; ``images`` holds each prompt's."""

    def __call__(self, prompts: list[str], images: list[list[bytes]], max_new_tokens: int, temperature: float) -> list[str]: ...


class PlainText:
    """Recognition of pages that hold UTF-8 text: the default, and what tests use."""

    def __call__(self, image: bytes) -> str:
        return image.decode("utf-8", "replace").strip()


def records_json(block: str) -> str:
    """A block as a catalogue record by rules: its first line is the family, each record's first line a species, and each other line a folder."""
    family, _, content = block.partition("\n")
    species = []
    for record in content.split("\n\n"):
        lines = [x for x in record.split("\n") if x.strip()]
        if lines:
            species.append({"species_name": lines[0], "number_of_folders": len(lines) - 1, "number_of_sheets": 0, "folders_and_sheets": [{"description": x} for x in lines[1:]]})
    return json.dumps({"family_name": family, "species": species}, ensure_ascii=False)


class Rules:
    """Transcription by rules of the last text of a conversation, behind its first blank line if there is a lead."""

    def __call__(self, messages: list[dict]) -> str:
        text = [p["text"] for m in messages for p in m["content"] if p["text"] is not None][-1]
        return records_json(text)


class Echo:
    """Generation without a model: each prompt and the last words before it asks, as many as there may be new tokens."""

    def __call__(self, prompts: list[str], images: list[list[bytes]], max_new_tokens: int, temperature: float) -> list[str]:
        return [p + " ".join(p.removesuffix(R.CHAT["ask"]).split()[-max_new_tokens:]) for p in prompts]


_MAKERS: dict[str, Callable[[], Callable]] = {"rules": Rules, "plain": PlainText, "echo": Echo}
_MADE: dict[str, Callable] = {}


def register(name: str, maker: Callable[[], Callable]) -> None:
    """M1: ``maker`` runs on the worker; it has to be importable or picklable there."""
    _MAKERS[name] = maker


def get_model(name: str) -> Callable:
    """M1, M8, M9: the backend of that name, made at its first use in this process."""
    if name not in _MADE:
        if name not in _MAKERS:
            raise ImportError(f"no backend named {name}; there are {', '.join(sorted(_MAKERS))}")
        _MADE[name] = _MAKERS[name]()
    return _MADE[name]


def unload(name: str) -> None:
    """M9."""
    _MADE.pop(name, None)


def _maker(name: str) -> Callable[[], Callable]:
    if name not in _MAKERS:
        raise ImportError(f"no backend named {name}; there are {', '.join(sorted(_MAKERS))}")
    return _MAKERS[name]


def _own(name: str, maker: Callable[[], Callable]) -> Callable:
    """On a worker, whose registry may lack what the driver registered."""
    if name not in _MADE:
        _MADE[name] = maker()
    return _MADE[name]


def recognized(images: DataFrame, model: str = "plain", content: str = "content", out: str = "text") -> DataFrame:
    """``images`` with their text. A null image has a null text."""
    maker = _maker(model)

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _own(model, maker)
        for s in batches:
            yield s.map(lambda b: None if b is None else own(bytes(b)).strip())

    return images.withColumn(out, read(F.col(content)))


def asked(model: str) -> Callable[[Column], Column]:
    """A model's answers to a column of conversations."""
    maker = _maker(model)

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _own(model, maker)
        for s in batches:
            out = []
            for messages in s:
                if messages is None:
                    out.append(None)
                    continue
                plain = [{"role": m["role"], "content": [dict(p) for p in m["content"]]} for m in messages]
                out.append(own(plain))
            yield pd.Series(out, dtype=object)

    return answer


def generated(prompts: DataFrame, model: str, prompt: str = "prompt", images: str | None = None, max_new_tokens: int = 1024, temperature: float = 0.01, batch: int = 10, out: str = "answer") -> DataFrame:
    """``prompts`` with what a ``Generator`` says to each, ``batch`` of them at a time, less the prompt in front. A null prompt has a null answer.

    ``images`` names a column of arrays of binaries. Sampling is the model's, at a ``temperature`` above 0.
    """
    if max_new_tokens < 1:
        raise ValueError("an answer has at least one token")
    maker = _maker(model)

    @F.pandas_udf("string")
    def answer(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        own = _own(model, maker)
        for asked_, shown in batches:
            out = [None] * len(asked_)
            at = [i for i, p in enumerate(asked_) if p is not None]
            for k in range(0, len(at), batch):
                some = at[k : k + batch]
                said = own([asked_.iloc[i] for i in some], [[bytes(b) for b in (() if shown.iloc[i] is None else shown.iloc[i])] for i in some], max_new_tokens, temperature)
                if len(said) != len(some):
                    raise ValueError(f"{len(said)} answers to {len(some)} prompts")
                for i, text in zip(some, said):
                    out[i] = text.removeprefix(asked_.iloc[i]).strip()
            yield pd.Series(out, dtype=object)

    return prompts.withColumn(out, answer(F.col(prompt), F.col(images) if images else F.lit(None).cast("array<binary>")))


def native_rules(family: Column, content: Column) -> Column:
    """What ``Rules`` answers, as an expression."""
    lines = lambda r: F.filter(F.split(r, "\n"), P.not_blank)
    records = F.filter(F.transform(F.split(content, "\n\n"), lines), lambda x: F.size(x) > 0)
    species = F.transform(
        records,
        lambda x: F.struct(
            F.get(x, F.lit(0)).alias("species_name"),
            (F.size(x) - 1).alias("number_of_folders"),
            F.lit(0).alias("number_of_sheets"),
            F.transform(F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))), lambda d: F.struct(d.alias("description"))).alias("folders_and_sheets"),
        ),
    )
    return F.to_json(F.struct(family.alias("family_name"), species.alias("species")))


def transcribed(blocks: DataFrame, config: R.Config, model: str | None = None) -> DataFrame:
    """M6: ``blocks`` (division, family, content, ...) with ``json``, ``verified``, ``record`` and ``error``.

    An answer that is no record is asked for once more with a prompt for its repair. What fails twice keeps its row, unverified: ``quarantine`` has it, and ``accepted`` what is left.
    """
    model = model or config["model"]
    subject = F.coalesce(F.when(F.col("family").isNull(), F.col("division")).otherwise(F.col("family")), F.lit(""))
    if model == "rules" and not config.get("user"):
        first = blocks.withColumn("json", native_rules(subject, F.col("content")))
        return J.verify(first, "json", "record")
    ask = asked(model)
    first = blocks.withColumn("json", ask(R.conversations(config, F.concat(subject, F.lit("\n"), F.col("content")))))
    once = J.verify(first, "json", "record", repair=True)
    retry = R.json_prompt("{broken}")[0]["content"][0]["text"].split("{broken}")
    again = F.array(F.struct(F.lit("system").alias("role"), F.array(F.struct(F.lit("text").alias("type"), F.concat(F.lit(retry[0]), F.col("json"), F.lit(retry[1])).alias("text"))).alias("content"))).cast(R.MESSAGES)
    good = once.where("verified")
    bad = once.where("not verified").drop("verified", "record", "error").withColumn("json", ask(again))
    return good.unionByName(J.verify(bad, "json", "record", repair=True))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where("verified").drop("verified", "error")


def quarantine(rows: DataFrame) -> DataFrame:
    """K7, Q11: what failed, with its answer and its error; never silently dropped."""
    return rows.where("not verified").drop("verified", "record")


def cleaned_by_model(texts: DataFrame, model: str, text: str = "text") -> DataFrame:
    """M7: each text as a model mends it, its own preamble removed."""
    from ..functions.text import drop_preamble

    lead = R.noise_prompt("{text}")
    parts = [p for m in lead for p in m["content"]]
    before, after = parts[1]["text"].split("{text}")
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.array(F.struct(F.lit("text").alias("type"), F.lit(parts[0]["text"]).alias("text"))).alias("content")),
        F.struct(F.lit("user").alias("role"), F.array(F.struct(F.lit("text").alias("type"), F.concat(F.lit(before), F.col(text), F.lit(after)).alias("text"))).alias("content")),
    ).cast(R.MESSAGES)
    return texts.withColumn(text, drop_preamble(asked(model)(messages)))


NAME = r"\b[A-Z][a-z]+(?= ([a-z]+))"


def dictionary_entities(names: DataFrame, name: str = "name") -> Callable[[DataFrame, str], DataFrame]:
    """M5: a function that adds ``entities``, the dictionary's two-word names found in a text, by an equi-join on candidate names."""

    def add(df: DataFrame, text: str) -> DataFrame:
        keys = [c for c in df.columns if c != text]
        pairs = F.zip_with(F.regexp_extract_all(text, F.lit(NAME), 0), F.regexp_extract_all(text, F.lit(NAME), 1), lambda a, b: F.concat(a, F.lit(" "), b))
        mentions = numbered_items(df, keys, F.array_distinct(pairs), "_at", "_name").drop("_at")
        known = names.select(F.col(name).alias("_name")).distinct()
        found = mentions.join(known, "_name").groupBy(*keys).agg(F.array_sort(F.collect_set("_name")).alias("entities"))
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        both = df.alias("l").join(found.alias("r"), same, "left")
        return both.select(*(F.col(f"l.{c}").alias(c) for c in df.columns), F.coalesce(F.col("r.entities"), F.array().cast("array<string>")).alias("entities"))

    return add


def backbone_match(entities: DataFrame, backbone: DataFrame, name: str = "name", family: str = "family") -> DataFrame:
    """``entities`` of several words, left joined to a backbone table (name, family, ...) on lower-cased names."""
    known = backbone.withColumns({"_n": F.lower(name), "_f": F.lower(family)}).drop(name, family)
    own = entities.where(P.several_words(F.col(name))).withColumns({"_n": F.lower(name), "_f": F.lower(family)})
    return own.join(known, ["_n", "_f"], "left").drop("_n", "_f")
