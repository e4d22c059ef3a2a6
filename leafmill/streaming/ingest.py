"""Continuous ingestion: pages as they arrive, cleaned, carried forward, and written in batches.

Interval saves of a batch run become micro-batches with a checkpoint: what has
been written is never rewritten, and a restart goes on where it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import predicates as P
from ..functions import text as T
from ..operators import segment as S

PAGES = "doc_id long, page_no int, text string"


def page_stream(spark: SparkSession, path: str, schema: str = PAGES, files_per_batch: int = 3) -> DataFrame:
    """K5: Parquet files of pages as a stream, a few files to a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def image_stream(spark: SparkSession, path: str, files_per_batch: int = 3) -> DataFrame:
    """S1 as a stream: new image files of a folder, by suffix."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_per_batch).load(path)
    named = files.withColumn("name", F.element_at(F.split("path", "/"), -1))
    return named.where(P.accepted_suffix(F.col("name"), any_case=False) & P.not_ignored(F.col("name"))).select("path", "name", "length", "content")


def cleaned(pages: DataFrame, text: str = "text") -> DataFrame:
    """T1 to T11 on a stream or a table."""
    return pages.withColumn(text, T.clean_page(F.col(text)))


def carried_divisions(pages: DataFrame, divisions: list[str]) -> DataFrame:
    """G2 across pages that arrive in order: (doc_id, page_no, ord, division, part), the division of a page's first part being the last of the pages before.

    The state is one string for each document. Pages of one document in one batch are put in order; a page that comes later than a following one has been read is taken as it comes.
    """
    pattern = S.division_pattern(divisions)
    heading = P.HEADING

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import re

        cut = re.compile(re.sub(r"^\(\?iu\)", "(?i)", pattern))
        division = state.get[0] if state.exists else None
        own = pd.concat(list(frames)).sort_values("page_no")
        out = []
        for page_no, text in zip(own["page_no"], own["text"]):
            if text is None:
                continue
            at, last, n = 0, None, 0
            pieces = []
            for m in cut.finditer(text):
                pieces.append((last, text[at : m.start()]))
                at, last = m.end(), m.group(1)
            pieces.append((last, text[at:]))
            for name, part in pieces:
                if name is not None and re.match(heading, name):
                    division = name
                elif name is not None:
                    part = name + part
                if part.strip("\n"):
                    out.append((int(key[0]), int(page_no), n, division, part))
                    n += 1
        state.update((division,))
        yield pd.DataFrame(out, columns=["doc_id", "page_no", "ord", "division", "part"]).astype({"doc_id": "int64", "page_no": "int32", "ord": "int32"})

    return pages.groupBy("doc_id").applyInPandasWithState(run, "doc_id long, page_no int, ord int, division string, part string", "division string", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, ts: str = "ts", kind: str = "event_type", size: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Tumbling windows of events with a watermark; events later than ``late`` are left out."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w"), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")


def run_to_end(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """K6: all that is there, in micro-batches of ``write(batch, number)``."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()


def to_parquet(path: str) -> Callable[[DataFrame, int], None]:
    """A batch as a folder of its own, overwritten when the batch is run again: each is there once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write
