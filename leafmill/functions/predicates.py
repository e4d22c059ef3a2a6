"""Row filters of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import quoted, strip

SUFFIXES = ("jpeg", "png", "jpg", "pdf")
IGNORED = (".DS_Store", ".git", "Thumbs.db", "cropped")
HEADING = r"^(?:\d+\.?\s+)?(?:[A-Z][a-z]+|[A-Z]+)\.?"
SPECIES_SHAPE = r"^\b[A-Z][a-z]+(?: [a-z]+)\s?(?:[a-zA-Z\[\]\(\)\.\s\,]+)?\b"
RECORD_INDEX = r"^(?:[0-9]+\.\s?)?(?:\s+|-)?"


def extension(path: Column) -> Column:
    return F.regexp_extract(path, r"\.([^./\\?#]+)(?:[?#].*)?$", 1)


def accepted_suffix(path: Column, any_case: bool = True) -> Column:
    """A single file's suffix counts in any case, a listed file's as it is."""
    e = extension(path)
    return (F.lower(e) if any_case else e).isin(*SUFFIXES)


def not_ignored(name: Column) -> Column:
    """P2."""
    return ~name.isin(*IGNORED)


def not_empty(text: Column) -> Column:
    """P5."""
    return text != ""


def not_noise(label: Column) -> Column:
    """P6."""
    return label != -1


def kept_fragment(x: Column) -> Column:
    """P7."""
    return (x != "") & ~x.rlike(r"\A\n+\z")


def is_heading(x: Column) -> Column:
    """P8."""
    return x.rlike(HEADING)


def not_blank(line: Column) -> Column:
    """P9."""
    return strip(line) != ""


def species_shaped(entity: Column) -> Column:
    """P10."""
    return entity.rlike(SPECIES_SHAPE)


def starts_record(line: Column, entities: Column) -> Column:
    """The line starts with one of the entities; without any, every line does."""
    alternatives = F.array_join(F.transform(entities, lambda e: F.concat(F.lit("\\Q"), e, F.lit("\\E"))), "|")
    return F.rlike(line, F.concat(F.lit(RECORD_INDEX + "(?:"), alternatives, F.lit(")")))


def starts_shaped_record(line: Column) -> Column:
    """P11 with the species shape in place of entities."""
    return line.rlike(RECORD_INDEX + r"[A-Z][a-z]+ [a-z]+")


def several_words(entity: Column) -> Column:
    """P12."""
    return F.size(F.split(entity, " ")) > 1


def whole_pair(*columns: str) -> Column:
    """P13."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def line_starts(text: Column, entity: Column) -> Column:
    """The places where a line starts with the entity, as the matches."""
    return F.regexp_extract_all(text, F.concat(F.lit("(?md)^\\Q"), entity, F.lit("\\E")), 0)


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("Column", "F", "annotations", "quoted", "strip")]
