"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits over word shingles. Two fingerprints link when they
differ in ``max_distance`` (0, 1 or 2) bits at most. The 64 bits are cut into
``segments``, each with a table keyed on its bits alone. Of two fingerprints
within the distance some segment differs in ``max_distance // segments`` bits at
most, so each fingerprint enumerates that small Hamming ball within each of its
segments, fetches what the tables hold there, and verifies the complete
distance. Of two fingerprints one bit apart in a segment one is the greater
there, and only that one needs to probe: only set bits are cleared, which halves
the ball. With two segments of 32 bits that is about 34 probes for each
distinct fingerprint.

A bucket of more than ``HOT`` fingerprints, as a large group of near copies may
fill, is not fetched, as that would compare all pairs of the group. The
fingerprints that lie in such buckets or probe them are linked by their balls in
the whole 64 bits instead: those that share a point of these balls are within 2
bits of each other, and a chain through them stands for all pairs. No link that
matters to components is lost either way.

Cases: a null text is empty; an empty or blank text has fingerprint zero, which
links like any other; equal texts share a fingerprint; repeated rows are kept;
very long texts are counted in batches; other columns are kept whatever their
names; a null doc_id is kept, and counts as larger than any other; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import connected_components, one_of_equal, positional, row_marks, scratch, written

_ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
BITS = 64
HOT = 64  #: fingerprints of a table's bucket above which it is not fetched


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of one text."""
    data = b" ".join(_WORDS.findall((text or "").encode("utf-8", "replace").translate(_ASCII_LOWER)))
    if not data:
        return 0
    ends = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) == 32), len(data))
    starts = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh64_intdigest
    n = max(1, len(ends) - size + 1)
    last = ends[size - 1 :] if len(ends) >= size else ends[-1:]
    counts, step = np.zeros(BITS, np.int64), 65536
    for i in range(0, n, step):  # bounded memory for texts of any length
        h = np.array([digest(data[a:b], seed) for a, b in zip(starts[i : min(n, i + step)].tolist(), last[i : i + step].tolist())], dtype=">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", column: str = "simhash", size: int = 3, seed: int = 42, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, by default all) with the fingerprint as a signed long in ``column``."""
    keep = docs.columns if keep is None else keep
    take = [*keep, *([] if text in keep else [text])]
    out = [(docs.schema[c].name, docs.schema[c].dataType) for c in keep]
    from pyspark.sql import types as T

    schema = T.StructType([*(T.StructField(n, t) for n, t in out), T.StructField(column, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = np.array([fingerprint(t, size, seed) for t in b.column(len(keep) if text not in keep else keep.index(text)).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(own.view(np.int64))], [*keep, column])

    return docs.select(*take).mapInArrow(run, schema)


def _signed(v: int) -> Column:
    return F.lit(v - (1 << 64) if v >> 63 else v).cast("long")


def segment_keys(value: Column, segments: int) -> list[tuple[Column, int]]:
    """Each segment's bits with its number above them, as one long, and how many bits it has."""
    if segments == 1:
        return [(value, BITS)]
    ends = [BITS * (s + 1) // segments for s in range(segments)]
    widths = [b - a for a, b in zip([0, *ends], ends)]
    return [(F.shiftrightunsigned(value, BITS - end).bitwiseAND(_signed((1 << w) - 1)).bitwiseOR(_signed(s << 32)), w) for s, (end, w) in enumerate(zip(ends, widths))]


def ball(key: Column, width: int, radius: int) -> Column:
    """``key`` and, for a radius of 1, what clearing one of its ``width`` low bits gives."""
    own = F.array(key)
    if not radius:
        return own
    bits = F.array(*(_signed(1 << i) for i in range(width)))
    return F.concat(own, F.transform(F.filter(bits, lambda b: key.bitwiseAND(b) != 0), lambda b: key.bitwiseXOR(b)))


def whole_ball_edges(prints: DataFrame, column: str, max_distance: int) -> DataFrame:
    """Links (src, dst) that connect all of ``prints`` within ``max_distance`` (1 or 2), by the ball of radius 1 in all bits; a point has 65 fingerprints at most."""
    masks = F.array(F.lit(0).cast("long"), *(_signed(1 << i) for i in range(BITS)))
    probes = prints.select(F.col(column).alias("p"), F.explode(masks).alias("m")).select("p", F.col("p").bitwiseXOR(F.col("m")).alias("probe"), (F.col("m") == 0).alias("own"))
    w = Window.partitionBy("probe").orderBy(F.desc("own"), "p")
    if max_distance == 1:  # only the probed fingerprint itself is within 1 bit of all in its bucket
        near = probes.select("p", F.first(F.when(F.col("own"), F.col("p")), ignorenulls=True).over(w).alias("q"))
    else:
        near = probes.select("p", F.lag("p").over(w).alias("q"))
    return near.where(f"q is not null and p <> q and bit_count(p ^ q) <= {max_distance}").select(F.col("p").alias("src"), F.col("q").alias("dst"))


def ball_edges(prints: DataFrame, column: str = "simhash", max_distance: int = 2, segments: int = 2, hot: int = HOT) -> DataFrame:
    """Links (src, dst) that connect all distinct fingerprints of ``prints`` within ``max_distance`` bits. ``prints`` is read often: have it written."""
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance is 0, 1 or 2")
    if not max_distance:
        return prints.select(F.col(column).alias("src"), F.col(column).alias("dst")).where("false")
    radius = max_distance // segments
    if radius > 1 or segments > BITS:
        raise ValueError("as many segments as max_distance at least, and no more than bits")
    own = segment_keys(F.col(column), segments)
    table = prints.select(F.col(column).alias("q"), F.explode(F.array(*(k for k, _ in own))).alias("key"))
    probes = prints.select(F.col(column).alias("p"), F.explode_outer(F.concat(*(ball(k, w, radius) for k, w in own))).alias("key"))
    full = written(table.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key"), "hot-buckets")
    crowded = bool(full.limit(1).count())
    if crowded:
        table = table.join(full, "key", "left_anti")
    links = probes.join(table, "key").where(f"p <> q and bit_count(p ^ q) <= {max_distance}").select(F.col("p").alias("src"), F.col("q").alias("dst"))
    if not crowded:
        return links
    members = probes.join(full, "key", "left_semi").select(F.col("p").alias(column)).distinct()
    return links.unionByName(whole_ball_edges(members, column, max_distance))


def components(prints: DataFrame, doc_id: str = "doc_id", column: str = "simhash", max_distance: int = 2) -> DataFrame:
    """(``column``, root, component_id): each distinct fingerprint's component, and the smallest doc_id in it. ``prints`` is read twice: have it written."""
    own = written(prints.groupBy(column).agg(F.min(doc_id).alias("_low")), "distinct")
    links = connected_components(ball_edges(own, column, max_distance))
    rooted = own.join(links.withColumnRenamed("node", column), column, "left").select(column, "_low", F.coalesce("component", column).alias("root"))
    least = rooted.groupBy("root").agg(F.min("_low").alias("component_id"))
    return rooted.join(least, "root").select(column, "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_distance: int = 2) -> DataFrame:
    """(doc_id, simhash, component_id) for every row."""
    prints = written(fingerprints(docs, text, keep=[doc_id]), "simhash")
    return prints.join(components(prints, doc_id, max_distance=max_distance), "simhash").select(doc_id, "simhash", "component_id")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_distance: int = 2) -> DataFrame:
    """One row of each component: that of the smallest doc_id, a null one last; of several rows with it, one.

    Rows are told apart by marks of all their columns, so rows of different components that share a doc_id are both kept.
    """
    rows = positional(docs)
    one, body = (rows.columns[docs.columns.index(c)] for c in (doc_id, text))
    marked = rows.select("*", *row_marks(rows))
    with scratch(docs.sparkSession):
        prints = written(fingerprints(marked, body, keep=[one, "_mark_a", "_mark_b"]), "simhash")
        groups = components(prints, one, max_distance=max_distance)
        first = F.min(F.struct(F.col(one).isNull().alias("none"), one, "_mark_a", "_mark_b")).alias("lead")
        keep = written(prints.join(groups, "simhash").groupBy("root").agg(first).select("lead._mark_a", "lead._mark_b"), "leads", lasting=True)
    return one_of_equal(marked).join(keep, ["_mark_a", "_mark_b"], "left_semi").select(rows.columns).toDF(*docs.columns)
