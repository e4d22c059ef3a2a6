"""Embedding near-duplicates by sorted projection passes.

Each pass draws its own random hyperplanes, concatenates their signs into one
sort key, orders the vectors by (label, key) and compares each with the next
``window`` in that order; pairs whose cosine is verified are united across
passes. Keys are of vectors less their label's mean, so that vectors about one
direction do not share most of their signs; cosines are of the vectors as they
are. The number of passes is measured for each label: partners are drawn at the
threshold to vectors of a sample of at most some ``SAMPLE``, and the ranks
between their keys say how often such a pair meets in a window. Passes are as
many as ``recall`` asks for on average over these pairs, ``MAX_PASSES`` at most
(where it binds, recall is lower), and never fewer than evenly spread keys need.
A pass is dealt over buckets of its key's quantiles; the key ends in hashed
bits of the id, so no set of alike vectors, however large, fills one bucket,
and a bucket's sorted rows are read as a stream that holds one window.

A pass passes on only links that join what it has not joined yet, one at most
for each vector. The number of links of a vector is then counted inside its
component, in tiles of ``TILE`` by ``TILE`` vectors that are dealt over tasks:
all pairs are compared there, and none is emitted.

Equal vectors of one label are taken once, and their count enters the links.

Cases: a vector that is null, zero, or holds null or non-finite components
links with nothing, and so does one of null label; vectors of other lengths
never link; repeated rows count as vectors of their own; an empty table gives
no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import connected_components, written

BITS = 40  #: sign bits of a key; the 23 below are of the id
WINDOW = 32
TILE = 512
MAX_BUCKETS = 4096
SAMPLE = 4096  #: vectors of a label on which its passes are measured
MAX_PASSES = 128


def passes_for(n: int, threshold: float, window: int = WINDOW, recall: float = 0.98) -> int:
    """Passes after which a pair at ``threshold`` has met in a window with probability ``recall``, if keys spread evenly."""
    same = 1 - math.acos(threshold) / math.pi
    met = same ** max(1.0, math.log2(max(2, n) / window))
    return max(6, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def measured_passes(sample: np.ndarray, mean: np.ndarray, n: int, threshold: float, window: int = WINDOW, recall: float = 0.98, seed: int = 7, trials: int = 32, probes: int = 192) -> int:
    """Passes that a label of ``n`` unit vectors with ``mean`` needs, from a ``sample`` of them."""
    if n <= window + 1:
        return 1
    rng = np.random.default_rng([seed, len(sample)])
    own = sample[rng.permutation(len(sample))[:probes]]
    aside = rng.standard_normal(own.shape)
    aside -= (aside * own).sum(axis=1, keepdims=True) * own
    length = np.sqrt((aside * aside).sum(axis=1, keepdims=True))
    partner = threshold * own + math.sqrt(max(0.0, 1 - threshold * threshold)) * aside / np.where(length > 0, length, 1)
    ratio, least = n / window, 4.0  # ranks of the sample that still tell distances apart
    near = max(least, len(sample) / ratio)
    met, wide = np.zeros(len(own)), np.zeros(len(own))
    none = np.zeros(1, np.int64)
    for p in range(trials):
        at = [np.searchsorted(np.sort(keys(sample - mean, none, 10_000 + p, seed)), keys(x - mean, none, 10_000 + p, seed)) for x in (own, partner)]
        apart = np.abs(at[0] - at[1])
        met += apart <= near
        wide += apart <= 8 * near
    share = (met + 4 * max(met.mean(), 0.5) / trials) / (trials + 4)
    if len(sample) / ratio < least:  # carried on as the power of the size that the sample shows
        power = math.log(max(wide.mean(), 0.5) / max(met.mean(), 0.5)) / math.log(8)
        share = share * (len(sample) / ratio / least) ** max(power, 0.0)
    for p in range(6, MAX_PASSES):
        if (1 - (1 - share) ** p).mean() >= recall:
            return p
    return MAX_PASSES


def hyperplanes(seed: int, number: int, dims: int) -> np.ndarray:
    return np.random.default_rng([seed, number, dims]).standard_normal((BITS, dims))


def unit(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    x = np.array(vectors, dtype=np.float64)
    top = np.abs(x).max(axis=1, keepdims=True)  # scaled first, so that no square over- or underflows
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True)), top


def keys(vectors: np.ndarray, tie: np.ndarray, number: int, seed: int) -> np.ndarray:
    """Sort keys (non-negative longs) of one pass."""
    bits = (vectors @ hyperplanes(seed, number, vectors.shape[1]).T) > 0
    return (bits @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))) << 23 | tie & ((1 << 23) - 1)


def window_links(ids: np.ndarray, groups: np.ndarray, vectors: np.ndarray, threshold: float, window: int) -> list[tuple[int, int]]:
    """Links that join all verified pairs at most ``window`` apart in the order given: one at most for each row."""
    parent = np.arange(len(ids))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for d in range(1, min(window, len(ids) - 1) + 1):
        near = (groups[d:] == groups[:-d]) & (np.einsum("ij,ij->i", vectors[d:], vectors[:-d]) >= threshold)
        for i in np.flatnonzero(near):
            a, b = root(i), root(i + d)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(ids[i]), int(ids[i + d])))
    return out


def near_duplicates(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.93, window: int = WINDOW, passes: int | None = None, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table``."""
    spark = table.sparkSession
    usable = (
        F.col(label).isNotNull()
        & F.col(vec_id).isNotNull()
        & F.coalesce(F.size(embedding) > 0, F.lit(False))
        & F.coalesce(F.forall(embedding, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists(embedding, lambda v: v != 0), F.lit(False))
    )
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.transform(embedding, lambda v: F.when(v == 0, F.lit(0).cast(table.schema[embedding].dataType.elementType)).otherwise(v)).alias("vec"), usable.alias("ok"))
    rows = rows.withColumn("vec_hash", F.when(F.col("ok"), F.sha2(F.array_join("vec", ","), 256)))
    light = written(rows.select("vec_id", "label", "vec_hash", "ok"), "vectors")
    # Of equal vectors the smallest id stands for all; ``copies`` are how many.
    classes = light.where("ok").groupBy("label", "vec_hash").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = written(
        rows.where("ok").select("vec_id", "label", "vec", "vec_hash")
        .join(classes.select("label", "vec_hash", F.col("rep").alias("vec_id"), "copies"), ["label", "vec_hash", "vec_id"])
        .groupBy("label", "vec_hash", "vec_id").agg(F.first("vec").alias("vec"), F.first("copies").alias("copies")),
        "classes",
    )
    # A representative has a number of its own: a vec_id may be in several classes where ids repeat.
    reps = reps.withColumn("node", F.xxhash64("label", "vec_hash"))
    n = reps.count()
    number = max(1, min(MAX_BUCKETS, n // 4096))
    floor = passes_for(n, threshold, window)
    narrow = "<f4" if dict(table.dtypes)[embedding] == "array<float>" else "<f8"

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for (at, dims), g in f.groupby([f["label"], f["vec"].map(len)]):
                yield pd.DataFrame({"label": [at], "dims": [dims], "n": [len(g)], "total": [unit(g["vec"].tolist())[0].sum(axis=0)]})

    def centre(f: pd.DataFrame) -> pd.DataFrame:
        number = int(f["n"].sum())
        return pd.DataFrame({"label": f["label"].iloc[:1], "dims": f["dims"].iloc[:1], "n": [number], "mean": [np.sum(f["total"].tolist(), axis=0) / number]})

    # One row for each label and length of vectors.
    means = reps.select("label", "vec").mapInPandas(summed, "label long, dims long, n long, total array<double>").groupBy("label", "dims").applyInPandas(centre, "label long, dims long, n long, mean array<double>")
    means = written(means, "means")
    sized = reps.select("node", F.col("label").cast("long").alias("label"), "vec", F.size("vec").cast("long").alias("dims"))

    def measured(f: pd.DataFrame) -> pd.DataFrame:
        count = measured_passes(unit(f["vec"].tolist())[0], np.array(f["mean"].iloc[0]), int(f["n"].iloc[0]), threshold, window, seed=seed)
        count = max(count, floor)
        return pd.DataFrame({"label": f["label"].iloc[:1], "dims": f["dims"].iloc[:1], "passes": [passes or count]})

    sample = sized.join(means, ["label", "dims"]).where(F.pmod(F.xxhash64("node", F.lit("sample")), F.col("n")) < SAMPLE)
    counts = written(sample.groupBy("label", "dims").applyInPandas(measured, "label long, dims long, passes int"), "passes")
    ready = sized.join(means.join(counts, ["label", "dims"]).select("label", "dims", "mean", "passes"), ["label", "dims"]).select("node", "label", "vec", "mean", "passes")

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for _, g in f.groupby([f["label"], f["vec"].map(len)]):
                x, _ = unit(g["vec"].tolist())
                moved, vec = x - np.array(g["mean"].iloc[0]), [np.asarray(v, narrow).tobytes() for v in g["vec"]]
                for p in range(int(g["passes"].iloc[0])):
                    yield pd.DataFrame({"pass": p, "key": keys(moved, g["node"].to_numpy(), p, seed), "label": g["label"].to_numpy(), "node": g["node"].to_numpy(), "vec": vec})

    passed = ready.mapInPandas(keyed, "pass int, key long, label long, node long, vec binary")
    if number > 1:
        # Quantiles of each pass's keys: MAX_PASSES x MAX_BUCKETS numbers at most.
        cuts = passed.groupBy("pass").agg(F.percentile_approx("key", [i / number for i in range(1, number)], 10 * number).alias("cuts")).collect()
        bounds = {r["pass"]: np.array(r["cuts"], np.int64) for r in cuts}
    else:
        bounds = {}
    shared = spark.sparkContext.broadcast(bounds)

    def bucketed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in keyed(frames):
            at = shared.value.get(int(f["pass"].iloc[0])) if len(f) else None
            yield f.assign(bucket=np.searchsorted(at, f["key"].to_numpy(), "right") if at is not None else 0)

    dealt = ready.mapInPandas(bucketed, "pass int, key long, label long, node long, vec binary, bucket long")

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for f in frames:
            f = f if tail is None else pd.concat([tail, f], ignore_index=True)
            width = f["vec"].map(len).to_numpy()
            most = width.max()
            x, _ = unit(np.frombuffer(b"".join(v.ljust(most, b"\0") for v in f["vec"]), narrow).reshape(len(f), -1))
            group = pd.util.hash_pandas_object(f[["pass", "bucket", "label"]].assign(width=width), index=False).to_numpy()
            links = window_links(f["node"].to_numpy(), group, x, threshold, window)
            if links:
                yield pd.DataFrame(links, columns=["src", "dst"])
            tail = f.iloc[-window:]

    found = dealt.repartition(F.col("pass"), F.col("bucket")).sortWithinPartitions("pass", "bucket", "label", "key", "node").mapInPandas(compared, "src long, dst long").distinct()
    roots = written(connected_components(found), "components")
    placed = written(reps.join(roots, "node").select("component", "node", "vec", "copies"), "members")
    # Tiles of each component: a member's block is a hash, and blocks are as many as its size asks for.
    sizes = placed.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    blocked = placed.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("component", "node", "vec", "copies", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block")

    def counted(f: pd.DataFrame) -> pd.DataFrame:
        x = [f[f["block"] == f["i"].iloc[0]], f[f["block"] == f["j"].iloc[0]]]
        same = f["i"].iloc[0] == f["j"].iloc[0]
        out = []
        for own, other in ((x[0], x[1]),) if same else ((x[0], x[1]), (x[1], x[0])):
            if len(own) and len(other):
                lens = {len(v) for v in own["vec"]} & {len(v) for v in other["vec"]}
                for k in lens:
                    a, b = own[own["vec"].map(len) == k], other[other["vec"].map(len) == k]
                    u, v = unit(a["vec"].tolist())[0], unit(b["vec"].tolist())[0]
                    c = b["copies"].to_numpy()
                    links = ((u @ v.T) >= threshold).astype(np.int64)
                    if same:
                        np.fill_diagonal(links, 0)
                    out.append(pd.DataFrame({"node": a["node"].to_numpy(), "links": links @ c}))
        return pd.concat(out) if out else pd.DataFrame({"node": [], "links": []}).astype("int64")

    # Dealt by tile: a dealing by component, which the join leaves, would do for the groups, and put all tiles of a component into one task.
    by_tile = tiles.repartition("component", "i", "j")
    links = by_tile.groupBy("component", "i", "j").applyInPandas(counted, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    lowest = reps.join(roots, "node", "left").select("node", "label", "vec_hash", "vec_id", "copies", F.coalesce("component", "node").alias("component"))
    least = lowest.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    info = lowest.join(least, "component").join(links, "node", "left").select("label", "vec_hash", "copies", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    out = light.join(info, ["label", "vec_hash"], "left")
    return out.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
