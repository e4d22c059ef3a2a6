"""What the registered queries share: tables, and feature text that both engines build alike.

The test tables hold almost nothing that the text operators act on, so queries
set each whole text into a frame of headings, page numbers and cut words. The
frames are one SQL expression for both engines, and no character is replaced.
DuckDB cannot decompose characters; ``decomposed`` writes the replacements out
for the letters and signs of Latin-1 and Latin Extended-A, the only ones beyond
ASCII in these tables.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIVISIONS = ["Dicotyledones", "Monocotyledones", "Filices"]
ENTITIES = ["Rosa canina", "Bellis perennis", "Poa annua", "Not a name", "lower case"]

_WHOLE = "coalesce(text, '')"

#: A page as it comes from recognition: page numbers, cut words, damaged endings, runs of blanks.
PAGE = """concat(chr(10), chr(10), chr(10), ' ', doc_id % 300, ' ', chr(10), chr(10), 'A cata-', chr(10), '  logue   of', chr(9), chr(9), 'plants', chr(10),
  'ROSAC FAE', chr(10), case when doc_id % 3 = 0 then 'COMPOSITAE Vaill.' when doc_id % 3 = 1 then 'See GRAMINEAE here' else 'LEGUMINOS EAF' end,
  chr(10), chr(10), chr(10), chr(10), doc_id, chr(10), {a}, chr(10), '12', chr(10), ' end  ')"""

#: A catalogue: two divisions, one mentioned in lower case, families with damaged endings, numbered species.
CATALOGUE = """concat('Preface ', doc_id, chr(10), 'Catalogue', chr(10), '1. DICOTYLEDONES.', chr(10), 'TRIBE IV.', chr(10), 'ROSACEAE', chr(10),
  '1. Rosa canina L.', chr(10), {a}, chr(10), 'One folder, ', doc_id % 7, ' sheets', chr(10), '- Rosa alba see the dicotyledones above', chr(10),
  case when doc_id % 4 = 0 then 'plain' else 'COMPOSITAE' end, chr(10), 'Bellis perennis L.', chr(10), 'in a  RANUNCUL.A. of floret rosace. note', chr(10),
  case when doc_id % 5 = 0 then 'Dicotyledones' else 'MONOCOTYLEDONES' end, chr(10), 'the GRAMINEAE of old', chr(10), 'SERIES II', chr(10), 'GRAMINEAE', chr(10), 'Poa annua L.', chr(10), 'Folder ', doc_id)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text() -> Column:
    return F.expr(_WHOLE)


def feature(frame: str) -> Column:
    return F.expr(frame.format(a=_WHOLE))


def feature_sql(frame: str = "{a}") -> str:
    return frame.format(a=_WHOLE)


def nested(expression: str, *steps: tuple[str, str]) -> str:
    """DuckDB SQL of global replacements, the first innermost."""
    for pattern, by in steps:
        expression = f"regexp_replace({expression}, '{pattern}', '{by}', 'g')"
    return expression


def stripped(expression: str) -> str:
    return nested(expression, (r"^\s+|\s+$", ""))


def decomposed(expression: str) -> str:
    """DuckDB SQL of the compatibility decomposition."""
    for c in map(chr, range(0xA0, 0x180)):
        by = unicodedata.normalize("NFKD", c)
        if by != c:
            expression = f"replace({expression}, '{c}', '{by}')"
    return expression
