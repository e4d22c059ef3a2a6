"""Text cleaning as Column -> Column functions; all but ``nfkd`` stay in the JVM.

Patterns use ``(?U)`` where white space, words and digits are Unicode's, and
``(?md)`` where a line ends at a line feed only. A null text stays null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Types

LEGACY_FAMILIES = ("COMPOSITAE", "GRAMINEAE", "LEGUMINOSAE", "PALMAE", "UMBELLIFERAE", "CRUCIFERAE", "LABIATAE", "GUTTIFERAE", "PAPILIONACEAE", "MIMOSACEAE", "CAESALPINIACEAE")
PAGE_FAMILY = rf"\b([A-Z]+ACEAE|{'|'.join(LEGACY_FAMILIES)})\b"
FAMILY = rf"\b([A-Z]+ACEAE|{'|'.join(LEGACY_FAMILIES)}|[A-Z]+EAE)\b"


def sub(c: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(c, pattern, by)


def strip(c: Column) -> Column:
    return sub(c, r"(?U)^\s+|\s+\z")


def quoted(literal: str) -> str:
    """A pattern for the literal itself."""
    return "".join("\\" + ch if ch in r"\.[]{}()*+-?^$|#&~" else ch for ch in literal)


def double_breaks(c: Column) -> Column:
    """Runs of line feeds become two."""
    return sub(c, r"\n{2,}", "\n\n")


def drop_page_numbers(c: Column) -> Column:
    """Lines of digits go, with blank lines before them."""
    return sub(c, r"(?mdU)^\s*\d+\s*$\n?")


def join_hyphens(c: Column) -> Column:
    """Words cut by a hyphen at a line's end are joined."""
    return sub(c, r"(?U)(\w+)-\s*\n\s*(\w+)", "$1$2")


def mend_suffixes(c: Column) -> Column:
    """T4: misread family endings become EAE."""
    return sub(c, r"(?U)([A-Z]+)\s*(EAE|FAE|EAF)", "$1EAE")


def single_breaks(c: Column) -> Column:
    """T5."""
    return sub(c, r"\n{2,}", "\n")


def single_spaces(c: Column) -> Column:
    """Runs of spaces and tabs become one space; the ends are stripped."""
    return strip(sub(c, r"[ \t]{2,}", " "))


def isolate_families(c: Column) -> Column:
    """A blank line before and after each family heading."""
    return sub(c, PAGE_FAMILY, "\n\n$1\n\n")


def cap_breaks(c: Column) -> Column:
    """T8."""
    return sub(c, r"\n{3,}", "\n\n")


@F.arrow_udf(Types.StringType())
def _nfkd(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for s in batches:  # in Arrow's own buffers; no text becomes an object of Python's
        yield pc.utf8_normalize(s, form="NFKD")


def nfkd(c: Column) -> Column:
    """Compatibility decomposition, the one step without a built-in function."""
    return _nfkd(c)


def fold_punctuation(c: Column) -> Column:
    """Typographic quotes, dashes and ellipses become plain ones."""
    return F.replace(F.translate(c, "‘’“”–—", "''\"\"--"), F.lit("…"), F.lit("..."))


def drop_preamble(c: Column) -> Column:
    """A leading remark of a model about its own output."""
    return sub(c, r"(?iuU)^(?:Cleaned|Corrected)\stext\s{0,1}:\s*")


def post_process(c: Column) -> Column:
    """Nothing."""
    return c


def clean_page_native(c: Column) -> Column:
    """T1 to T8."""
    for step in (double_breaks, drop_page_numbers, join_hyphens, mend_suffixes, single_breaks, single_spaces, isolate_families, cap_breaks):
        c = step(c)
    return c


def clean_page(c: Column) -> Column:
    """One page's text."""
    return strip(fold_punctuation(nfkd(clean_page_native(c))))


def from_division(c: Column, name: str) -> Column:
    """What stands before the first ``name`` goes."""
    return sub(c, rf"(?sui)^.*?({quoted(name)})", "$1")


def drop_catalogue_lines(c: Column) -> Column:
    """T16."""
    return sub(c, r"(?md)^(?:Catalogue|catalogue)$")


def unligature(c: Column) -> Column:
    """T17."""
    return F.replace(F.replace(c, F.lit("Æ"), F.lit("AE")), F.lit("œ"), F.lit("ae"))


#: T18 to T23, in order: (pattern, compat replacement, safe replacement, which keeps the stem).
ENDINGS = (
    (r"(?: [A-Z]{2,})\.A\.", "EAE"),
    (r"(?: [A-Z]{2,})E(?:\.|A)?E\.?", "EAE"),
    (r"(?: [A-Z]{2,})ACE(?:\.|A)?(?:\.|E)?\.?", "ACEAE"),
    (r"ace(?:\.|a)?e\.?", "aceae"),
    (r"(?: [A-Z]{2,})FLOR(?:\.|A)?(?:\.|E)?\.?", "FLORAE"),
    (r"flor(?:\.|a)?e", "florae"),
)
SERIES = r"(?mdiuU)^(?:TRIBE|SERIES)\s+[IVXLCDM\.]+\s*[A-Z.]*$"


def mend_endings(c: Column, mode: str = "compat") -> Column:
    """T18 to T23. ``safe`` keeps the stems that ``compat`` loses."""
    for pattern, by in ENDINGS:
        if mode == "safe" and pattern.startswith("(?: "):
            c = sub(c, pattern.replace("(?: [A-Z]{2,})", "( [A-Z]{2,}?)", 1), "$1" + by)
        else:
            c = sub(c, pattern, by)
    return c


def drop_series(c: Column) -> Column:
    """Lines that only name a tribe or series."""
    return sub(c, SERIES)


def preprocess(c: Column, first_division: str, mode: str = "compat") -> Column:
    """One catalogue's text."""
    return drop_series(mend_endings(unligature(drop_catalogue_lines(from_division(c, first_division))), mode))


def eval_normal(c: Column, species: bool = False) -> Column:
    """Text as the evaluation compares it; of species the first three tokens between single spaces."""
    c = F.replace(F.lower(strip(nfkd(c))), F.lit("\\"), F.lit(""))
    return F.array_join(F.slice(F.split(c, " "), 1, 3), " ") if species else c
