"""Near copies by the similarity of their word shingles.

Two texts link when the Jaccard similarity of their sets of five-word shingles
is 0.8 or more. Candidates come from SimHash by multi-index hashing: each bit of
a fingerprint is the majority of a bit of all shingles' hashes, and the
fingerprint is cut into ``SEGMENTS`` of ``WIDTH`` bits with a table each. At 0.8
a bit differs with probability 0.15, nearly always where the majority is
narrow, so within a segment the ball that is probed flips the ``FLIPS`` bits of
narrowest majority only, for both texts of a pair. What meets in a table is
verified by the distance of ``WORDS`` times ``BITS`` bits, most of which are in
no table, and then on the complete sets of shingles. In sets of up to ``FEW``
shingles majorities say little; these meet by what is left of them without any
two shingles as well.

No pair is put out before it is verified on the sets. The tables are dealt by
segment, and by leading bits of it where there are many nodes, as arrays; a
task compares the nodes of its buckets in memory and puts out, for each node at
most once, that it is near to some other. A bucket of more than ``CROWD`` nodes
is not compared but taken as near altogether. What is connected so is a group,
and holds every candidate pair. Only sets of groups' nodes are moved.

A group of up to ``TILE`` nodes is compared in full in one place, and only links
that join something are put out. A larger one is first compared within blocks
of that size, ``ROUNDS`` times by other hashes, which unites the most of it; then
all nodes that are not of its largest component are compared with all of its
nodes, in tiles that are dealt over tasks.

Equal sets are one node from the start.

Cases: blank and null texts have one empty set, and are alike; a text of fewer
than five words is one shingle; repeated rows, and rows that share a doc_id,
are told apart by all their columns; a null doc_id counts as larger than any
other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import connected_components, one_of_equal, positional, row_marks, scratch, written
from .simhash import _ASCII_LOWER, _WORDS, BITS

SIZE = 5  #: words of a shingle
SIMILARITY = 0.8
SEGMENTS, WIDTH, FLIPS = 45, 24, 2
RADIUS = 21  #: of ``BITS`` bits; a pair at 0.8 differs in 10, two unlike texts in 32
WORDS = 3  #: of ``BITS`` bits, that are compared; all but the first are in no table
FEW = 14
CROWD = 1024  #: nodes of a bucket above which their distances are not compared
ENTRIES = 1 << 20  #: of a table that a task holds, about
TILE, TILE_BYTES = 256, 8 << 20  #: nodes of a block, and bytes of their sets, about
ROUNDS = 2
BITMAP = 1 << 16  #: longs
_IN_TABLES = -(-SEGMENTS * WIDTH // BITS)  # words of 64 bits
_WORDS_OF = _IN_TABLES + WORDS - 1
_NODE = np.dtype([("node", "<i8"), ("print", "<u8", WORDS)])
_SEEDS = np.arange(1, _WORDS_OF + 1, dtype=np.uint64) << np.uint64(32)


def _hashes(text: str | None, size: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles of ``size`` words, in batches of bounded size; none for a blank text."""
    data = b" ".join(_WORDS.findall((text or "").encode("utf-8", "replace").translate(_ASCII_LOWER)))
    if not data:
        return
    ends = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) == 32), len(data))
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(ends) - size + 1)
    last = ends[size - 1 :] if len(ends) >= size else ends[-1:]
    step = 65536
    for i in range(0, n, step):
        yield np.array([xxhash.xxh64_intdigest(data[a:b], seed) for a, b in zip(starts[i : min(n, i + step)].tolist(), last[i : i + step].tolist())], dtype=np.uint64)


def shingles(text: str | None, size: int = SIZE, seed: int = 42) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles, of 32 bits each: of a million shingles some hundred share one."""
    parts = [np.unique((h >> np.uint64(32)).astype(np.uint32)) for h in _hashes(text, size, seed)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)


def votes(own: np.ndarray) -> np.ndarray:
    """For each bit of the fingerprint, how many of the shingles have it set."""
    out = np.zeros(_WORDS_OF * BITS, np.int64)
    for i in range(0, len(own), 255):  # counts of 8 bits
        x = (own[i : i + 255, None].astype(np.uint64) | _SEEDS) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        out += np.unpackbits(x.astype(">u8").view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return out


def segment_keys(own: np.ndarray) -> tuple[int, np.ndarray]:
    """(the bits that are compared, the first ``BITS`` of the fingerprint lowest; its keys in the tables) of a set of shingles; no keys of an empty one."""
    if not len(own):
        return 0, np.zeros(0, np.int32)
    margin = 2 * votes(own) - len(own)
    bits = margin > 0
    cut = slice(SEGMENTS * WIDTH)
    powers = 1 << np.arange(WIDTH)
    narrow = np.argsort(np.abs(margin[cut]).reshape(SEGMENTS, WIDTH), axis=1, kind="stable")[:, :FLIPS]
    keys = (bits[cut].reshape(SEGMENTS, WIDTH) @ powers + (np.arange(SEGMENTS) << WIDTH))[:, None]
    for k in range(FLIPS):
        keys = np.hstack([keys, keys ^ powers[narrow[:, k : k + 1]]])
    keys = keys.ravel().tolist()
    if len(own) <= FEW:
        less = [np.delete(own, c) for n in range(3) for c in combinations(range(len(own)), n)]
        keys += {-1 - (xxhash.xxh64_intdigest(x.tobytes(), 2) >> 33) for x in less if len(x)}
    compared = np.append(bits[_IN_TABLES * BITS :], bits[:BITS])
    return int.from_bytes(np.packbits(compared).tobytes(), "big"), np.array(keys, np.int32)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def signed(docs: DataFrame, doc_id: str, text: str, extra: list[str]) -> DataFrame:
    """(doc_id, extra, node, print, keys, shingles) of each row; ``node`` is of the whole set."""
    kinds = dict(docs.dtypes)
    keep = [doc_id, *extra]
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "node long, print binary, keys array<int>, shingles binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [shingles(t) for t in b.column(len(keep)).to_pylist()]
            sets = [s.tobytes() for s in own]
            nodes = np.array([xxhash.xxh64_intdigest(s, 1) for s in sets], np.uint64).view(np.int64)
            prints, keys = zip(*map(segment_keys, own)) if own else ((), ())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(nodes), pa.array([p.to_bytes(WORDS * BITS // 8, "little") for p in prints], pa.binary()), pa.array(keys, pa.list_(pa.int32())), pa.array(sets, pa.binary())], [*keep, "node", "print", "keys", "shingles"])

    return docs.select(*keep, text).mapInArrow(run, schema)


def joined(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``low``, the smallest node that each is connected with, after the pairs (``a``, ``b``) as well."""
    while True:
        x, y = low[a], low[b]
        if (x == y).all():
            return low
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while ((up := low[low]) != low).any():
            low = up


def near_in_buckets(nodes: np.ndarray, own: np.ndarray, keys: np.ndarray, hot: int) -> np.ndarray:
    """For each of ``nodes``, the smallest that it is connected with by pairs within the radius that share a key; ``own`` is the node of each of ``keys``."""
    low, order = np.arange(len(nodes)), np.argsort(keys, kind="stable")
    own, keys, prints = own[order], keys[order], nodes["print"]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    for m in np.unique(sizes[sizes > 1]).tolist():
        at = starts[sizes == m]
        i, j = np.triu_indices(m, 1) if m <= hot else (np.zeros(m - 1, int), np.arange(1, m))
        step = max(1, (1 << 20) // len(i))
        for k in range(0, len(at), step):
            held = own[at[k : k + step, None] + np.arange(m)]
            a, b = held[:, i].ravel(), held[:, j].ravel()
            apart = low[a] != low[b]
            a, b = a[apart], b[apart]
            if m <= hot:
                near = np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int64) <= WORDS * RADIUS
                a, b = a[near], b[near]
            low = joined(low, a, b)
    return low


def near_nodes(signs: DataFrame, hot: int) -> DataFrame:
    """(src, dst) that connect all nodes (node, print, keys) that share a key and are within the radius, and may connect more; a table's task puts out each ``src`` once."""
    split = max(0, ((signs.count() << FLIPS) // ENTRIES).bit_length())  # leading bits that a segment's tables are dealt by

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            names, first = np.unique(b.column(0).to_numpy(), return_index=True)
            new = [i for n, i in zip(names.tolist(), first.tolist()) if n not in seen]
            seen.update(names.tolist())
            b = b.take(pa.array(new, pa.int64()))
            nodes = np.zeros(b.num_rows, _NODE)
            nodes["node"] = b.column(0).to_numpy()
            nodes["print"] = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u8").reshape(-1, WORDS)
            keys = b.column(2).flatten().to_numpy().astype(np.int64)
            own = np.repeat(np.arange(len(nodes)), b.column(2).value_lengths().to_numpy())
            less = -1 - keys  # of few shingles, 31 bits
            table = np.where(keys >= 0, keys >> WIDTH, SEGMENTS + (less & 31)) << split
            table |= np.where(keys >= 0, (keys & (1 << WIDTH) - 1) >> WIDTH - split, less >> 31 - split)
            order = np.argsort(table, kind="stable")
            own, keys, table = own[order], keys[order].astype("<i4"), table[order]
            cuts = np.flatnonzero(np.append(True, table[1:] != table[:-1])) if len(table) else []
            rows = []
            for i, j in zip(cuts, [*cuts[1:], len(table)]):
                docs, counts = np.unique(own[i:j], return_counts=True)
                rows.append((int(table[i]), nodes[docs].tobytes(), counts.astype("<i2").tobytes(), keys[i:j].tobytes()))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["part", "nodes", "counts", "keys"])

    def met(t: pa.Table) -> pa.Table:
        nodes, counts, keys = (np.frombuffer(b"".join(t[c].to_pylist()), d) for c, d in (("nodes", _NODE), ("counts", "<i2"), ("keys", "<i4")))
        _, first, own = np.unique(nodes["node"], return_index=True, return_inverse=True)
        once = np.zeros(len(nodes), bool)  # equal sets of several tasks
        once[first] = True
        use = np.repeat(once, counts)
        low = near_in_buckets(nodes[first], np.repeat(own, counts)[use], keys[use], hot)
        names = nodes["node"][first]
        src = np.flatnonzero(low != np.arange(len(low)))
        return pa.table({"src": names[src], "dst": names[low[src]]})

    parts = signs.select("node", "print", "keys").mapInArrow(dealt, "part int, nodes binary, counts binary, keys binary")
    return parts.groupBy("part").applyInArrow(met, "src long, dst long")


def in_both(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``a`` shares with each of ``b``."""
    if len(a) * len(b) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in b] for x in a], np.int64).reshape(len(a), len(b))
    flat = [np.concatenate(s) if s else np.zeros(0, np.uint32) for s in (a, b)]
    both = np.intersect1d(*flat)
    rows, places = [], []
    for sets, x in zip((a, b), flat):
        at = np.searchsorted(both, x)
        hit = np.isin(x, both)
        row, at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit], at[hit]
        order = np.argsort(at, kind="stable")
        rows.append(row[order])
        places.append(at[order])
    out, step = np.zeros((len(a), len(b)), np.int64), 4096
    for i in range(0, len(both), step):
        holds = []
        for sets, row, at in zip((a, b), rows, places):
            p, q = np.searchsorted(at, [i, i + step])
            holds.append(np.zeros((len(sets), step), np.float32))
            holds[-1][row[p:q], at[p:q] - i] = 1
        out += (holds[0] @ holds[1].T).astype(np.int64)
    return out


def tile_links(own: pd.DataFrame, other: pd.DataFrame, similarity: float) -> list[tuple[int, int]]:
    """Links that join all pairs of a row of ``own`` and one of ``other`` (node, comp, shingles) that are of different components, and are alike."""
    sets = [[np.frombuffer(x, np.uint32) for x in f["shingles"]] for f in (own, other)]
    size = [np.array([len(x) for x in g]) for g in sets]
    shared = in_both(*sets)
    alike = shared / np.maximum(size[0][:, None] + size[1][None, :] - shared, 1) >= similarity
    alike &= own["comp"].to_numpy()[:, None] != other["comp"].to_numpy()[None, :]
    names, root, out = [own["node"].tolist(), other["node"].tolist()], {}, []

    def find(x):
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    for i, j in zip(*(x.tolist() for x in np.nonzero(alike))):
        a, b = find(names[0][i]), find(names[1][j])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((min(names[0][i], names[1][j]), max(names[0][i], names[1][j])))
    return out


def rest_links(left: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (src, dst) that join nodes of different components in the groups that buckets of ``left`` (key, node, own) connect."""
    lows = left.groupBy("key").agg(F.min("node").alias("low"))
    groups = connected_components(left.join(lows, "key").select(F.col("node").alias("src"), F.col("low").alias("dst")))
    groups = written(groups.select("node", F.col("component").alias("grp")), "groups")
    used = perhaps_in(sets.select("node", "shingles"), "node", bitmap(groups, "node")).where("perhaps").drop("perhaps").dropDuplicates(["node"])
    members = left.select("node", F.col("own").alias("comp")).distinct().join(groups, "node").join(used, "node")
    members = written(members, "members")
    count = F.ceil(F.greatest(F.count("*") / TILE, F.sum(F.length("shingles")) / TILE_BYTES)).cast("int")
    large = written(members.groupBy("grp").agg(count.alias("blocks")).where("blocks > 1"), "large")

    def frame(links: list[tuple[int, int]]) -> pd.DataFrame:
        return pd.DataFrame(links, columns=["src", "dst"]).astype("int64")

    def inside(f: pd.DataFrame) -> pd.DataFrame:
        return frame(tile_links(f, f, similarity))

    def across(f: pd.DataFrame) -> pd.DataFrame:
        return frame(tile_links(f[f["few"]], f[~f["few"]], similarity))

    def block(n, k: int):
        return F.pmod(F.xxhash64("node", F.lit(k)), n).cast("int")

    whole = members.join(large, "grp", "left").withColumn("block", block(F.coalesce("blocks", F.lit(1)), 0))
    links = written(whole.select("grp", "block", "node", "comp", "shingles").groupBy("grp", "block").applyInPandas(inside, "src long, dst long"), "links")
    if not large.limit(1).count():
        return links
    many = members.join(large, "grp")
    before = many.select(F.col("node").alias("src"), F.col("comp").alias("dst"))
    for k in range(1, ROUNDS + 1):
        now = connected_components(before.unionByName(links.join(many.select(F.col("node").alias("src")), "src", "left_semi")))
        placed = many.join(now, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
        if k == ROUNDS:
            break
        again = placed.withColumn("block", block(F.col("blocks"), k)).select("grp", "block", "node", "comp", "shingles")
        links = written(links.unionByName(again.groupBy("grp", "block").applyInPandas(inside, "src long, dst long")), "links")
    placed = written(placed, "placed")
    most = placed.groupBy("grp", "comp").agg(F.count("*").alias("n")).groupBy("grp").agg(F.max_by("comp", F.struct("n", "comp")).alias("most"))
    apart = placed.join(most, "grp").where("comp <> most").drop("most")
    parts = apart.groupBy("grp").agg(count.alias("parts"))
    columns = ["grp", "i", "j", "few", "node", "comp", "shingles"]
    few = apart.join(parts, "grp").withColumns({"i": block(F.col("parts"), 0), "j": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "few": F.lit(True)})
    rest = placed.join(parts, "grp").withColumns({"i": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), "j": block(F.col("blocks"), 0), "few": F.lit(False)})
    # Dealt by tile, so that no group's tiles meet in one task.
    tiles = few.select(columns).unionByName(rest.select(columns)).groupBy("grp", "i", "j")
    return links.unionByName(tiles.applyInPandas(across, "src long, dst long"))


def bitmap(rows: DataFrame, column: str) -> DataFrame:
    """(word, mask): the hashes in ``column`` as a bitmap of ``BITMAP`` longs, however many there are."""
    bit = F.pmod(F.col(column), F.lit(BITMAP * 64))
    bits = rows.select(bit.alias("bit")).selectExpr("cast(bit div 64 as int) as word", "shiftleft(1L, cast(bit % 64 as int)) as mask")
    return bits.groupBy("word").agg(F.bit_or("mask").alias("mask"))


def perhaps_in(rows: DataFrame, column: str, words: DataFrame) -> DataFrame:
    """``rows`` with ``perhaps``: false only where ``column`` is none of the hashes of a ``bitmap``."""
    bit = f"pmod(`{column}`, {BITMAP * 64}L)"
    named = rows.withColumn("_word", F.expr(f"cast({bit} div 64 as int)")).join(F.broadcast(words.select(F.col("word").alias("_word"), F.col("mask").alias("_mask"))), "_word", "left")
    return named.withColumn("perhaps", F.expr(f"coalesce(_mask & shiftleft(1L, cast({bit} % 64 as int)) <> 0, false)")).select(*rows.columns, "perhaps")


def components(signs: DataFrame, similarity: float = SIMILARITY, hot: int = CROWD) -> DataFrame:
    """(node, component) of each node that links with another. ``signs`` (node, print, keys, shingles) is read often: have it written."""
    near = written(near_nodes(signs, hot).distinct(), "near")
    ends = near.select(F.col("dst").alias("key"), F.explode(F.array("src", "dst")).alias("node")).distinct()
    links = rest_links(ends.withColumn("own", F.col("node")), signs, similarity)
    return connected_components(links)


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each component: that of the smallest doc_id, a null one last; of several rows with it, one."""
    rows = positional(docs)
    one, body = (rows.columns[docs.columns.index(c)] for c in (doc_id, text))
    marked = rows.select("*", *row_marks(rows))
    with scratch(docs.sparkSession):
        signs = written(signed(marked, one, body, ["_mark_a", "_mark_b"]), "shingles")
        groups = components(signs.select("node", "print", "keys", "shingles"), similarity)
        first = F.min(F.struct(F.col(one).isNull().alias("none"), one, "_mark_a", "_mark_b")).alias("lead")
        placed = signs.select(one, "_mark_a", "_mark_b", "node").join(groups, "node", "left").withColumn("root", F.coalesce("component", "node"))
        leads = written(placed.groupBy("root").agg(first, F.count("*").alias("n")), "roots")
        shared = placed.join(leads.where("n > 1").select("root"), "root", "left_semi")
        words = written(bitmap(shared, "_mark_a"), "words", lasting=True)
        keep = written(leads.select("lead._mark_a", "lead._mark_b"), "leads", lasting=True)
    # Rows that are alone stay where they are.
    rows = perhaps_in(marked, "_mark_a", words)
    some = one_of_equal(rows.where("perhaps").drop("perhaps")).join(keep, ["_mark_a", "_mark_b"], "left_semi")
    alone, some = (r.drop("_mark_a", "_mark_b") for r in (rows.where("not perhaps").drop("perhaps"), some))
    return alone.unionByName(some).toDF(*docs.columns)
