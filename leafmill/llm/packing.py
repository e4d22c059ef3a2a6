"""Packing token sequences by minimum bin slack.

A document is its token ids and one end id. Whole windows are cut off its
front; the rest, up to a window long, is one piece. Pieces are known by
their lengths alone: a histogram of at most ``window`` counts, whatever the
corpus holds. Over that histogram, subset-sum dynamic programming on bitsets
picks the multiset of lengths that fills a window closest to its capacity, and
backtracking gives how often each length is taken; where no multiset fills it,
one more piece is cut to close it. A pattern is repeated while its counts last,
so each use ends one length at least, and the whole plan takes a few thousand
steps on the driver.

Pieces then find their place in the plan by their rank within their length.
Ranks are of light rows, a number and a length for each piece, counted in
buckets of a hash of the number, so that no length, however frequent, lands in
one task; ids are moved once, to be joined with their places, and are never
sorted. A row holds one window's ids at most, whatever the document's length.

Cases: a null text is empty, and is its end id alone; rows with the same
doc_id are packed each; very long texts are cut into windows as they are
tokenized; columns other than the two named are not read, whatever their names;
an empty table gives no pieces.
"""

from __future__ import annotations

import os.path
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import written

REMEMBERED = 128 << 20  #: bytes that a tokenizer's table of known words holds, about
ENTRY = 180  #: bytes of an entry besides its characters
BATCH = 4 << 20  #: bytes of ids that leave a worker at once


class Known:
    """Ids of short strings, in a table of bounded bytes: when its young half is full, that takes the place of the old one."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def keep(self, w: str, b: bytes) -> None:
        if len(w) <= 40:
            self.held += ENTRY + len(w) + len(b)
            if self.held > REMEMBERED // 2:
                self.old, self.young, self.held = self.young, {}, 0
            self.young[w] = b


class WordTokenizer:
    """Ids of a lower-casing BPE with word ends. White space always separates tokens there, so chunks between white space are encoded once and remembered in a table of bounded size.

    Words of ASCII and Latin-1 letters are merged by rank over single bytes
    (a byte that ends a word is written as another, free byte); all other
    chunks are encoded by the library.
    """

    _made: dict[tuple[str, int], "WordTokenizer"] = {}

    @classmethod
    def of(cls, path: str, width: int = 4) -> "WordTokenizer":
        if (path, width) not in cls._made:
            cls._made[path, width] = cls(path, width)
        return cls._made[path, width]

    def __init__(self, path: str, width: int = 4):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        from .token_counts import byte_alphabet

        spec = json.load(open(path, encoding="utf-8"))
        self.kind = "H" if width == 2 else "I"
        self.library = Tokenizer.from_file(path)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.mark = os.path.commonprefix(special)  # a text without it has no special string
        end, back = spec["model"].get("end_of_word_suffix") or "", byte_alphabet()
        lasts = [*range(97, 123), *range(0x80, 0xC0)]
        free = [b for b in range(256) if b not in lasts and b not in (0xC2, 0xC3)]
        self.last = dict(zip(lasts, (bytes([b]) for b in free)))
        used, ranks, ids = {*lasts, 0xC2, 0xC3}, {}, {}
        for s, i in spec["model"]["vocab"].items():
            closed = bool(end) and s.endswith(end)
            raw = [back.get(c) for c in (s[: -len(end)] if closed else s)]
            if s in special or not raw or not all(b in used for b in raw):
                continue
            if closed and raw[-1] not in self.last:
                continue
            ranks[bytes(raw[:-1]) + self.last[raw[-1]] if closed else bytes(raw)] = i
        for b in range(256):  # every byte needs a rank of its own; those that no word holds get high ones
            ranks.setdefault(bytes([b]), 1_000_000 + b)
        self.merger = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.cut = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")
        self.plain = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
        self.odd = re.compile(r"[\x1c-\x1f]")  # white space to str.split() only
        self.letters = re.compile(r"[a-zß-öø-ÿ]+")
        self.known = Known()  # chunks, and the words that these are cut into: a word is a chunk, with the same ids

    def packed(self, ids) -> bytes:
        out = array(self.kind, ids)
        if sys.byteorder != "little":
            out.byteswap()
        return out.tobytes()

    def of_word(self, w: str) -> bytes:
        if self.letters.fullmatch(w):
            raw = w.encode("utf-8")
            ids = self.merger._encode_single_piece(raw[:-1] + self.last[raw[-1]])
            if max(ids) < 1_000_000:
                return self.packed(ids)
        return self.packed(self.library.encode(w, add_special_tokens=False).ids)

    def of_chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():  # one word
            return self.of_word(chunk) if chunk.islower() else self.remembered(chunk.lower())
        if not self.plain.fullmatch(chunk):
            return self.packed(self.library.encode(chunk, add_special_tokens=False).ids)
        return b"".join(map(self.remembered, self.cut.findall(chunk.lower())))

    def remembered(self, w: str) -> bytes:
        b = self.known.young.get(w)
        if b is None:
            b = self.known.old.get(w) or self.of_word(w)
            self.known.keep(w, b)
        return b

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned ids of ``width`` bytes."""
        if not text:
            return b""
        if self.special is not None and self.mark in text and self.special.search(text) or self.odd.search(text):
            return self.packed(self.library.encode(text, add_special_tokens=False).ids)
        parts = text.split()
        known = self.known
        found = list(map(known.young.get, parts))
        if None in found:
            fresh: dict[str, bytes] = {}  # of this text only
            for i, b in enumerate(found):
                if b is None:
                    c = parts[i]
                    b = fresh.get(c)
                    if b is None:
                        b = fresh[c] = known.old.get(c) or self.of_chunk(c)
                        known.keep(c, b)
                    found[i] = b
        return b"".join(found)


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, with counts, whose sum is the closest to ``capacity`` from below: bitset subset sums, then backtracking."""
    full, reach, stack = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left, k = min(counts[length], capacity // length), 1
        while left:
            take = min(k, left)
            stack.append((reach, length, take))
            reach |= (reach << (take * length)) & full
            left, k = left - take, k * 2
            if reach >> capacity & 1:
                left = 0
        if reach >> capacity & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for before, length, take in reversed(stack):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + take
            at -= take * length
    return out


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """How all pieces of ``histogram`` (length: count) fill windows, and the number of windows.

    A run (length, low, per, times, first, at, cut, back) says: of the pieces of
    ``length``, those of ranks ``low`` to ``low + per * times`` go to windows
    ``first`` on, ``per`` to each, at offset ``at``. Where no multiset fills a
    window, one more piece is cut to close it: only its first ``cut`` ids go
    there, and what is left is a piece of ``length - cut`` and of rank ``back``
    on. So every window is full but the last.
    """
    left = {k: v for k, v in histogram.items() if v > 0}
    taken: dict[int, int] = {}
    ranks = dict(left)
    runs, first = [], 0
    while left:
        pick = best_fill(left, capacity)
        slack = capacity - sum(k * n for k, n in pick.items())
        need = dict(pick)
        longer = next((k for k in sorted(left, reverse=True) if k > slack and left[k] > pick.get(k, 0)), None) if slack else None
        if longer is not None:
            need[longer] = need.get(longer, 0) + 1
        times = min(left[k] // n for k, n in need.items())
        at = 0
        for k, n in sorted(pick.items(), reverse=True):
            runs.append((k, taken.get(k, 0), n, times, first, at, k, 0))
            taken[k] = taken.get(k, 0) + n * times
            at += k * n
        if longer is not None:
            rest = longer - slack
            runs.append((longer, taken.get(longer, 0), 1, times, first, at, slack, ranks.get(rest, 0)))
            taken[longer] = taken.get(longer, 0) + times
            ranks[rest] = ranks.get(rest, 0) + times
            left[rest] = left.get(rest, 0) + times
        for k, n in need.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        first += times
    return runs, first


class Places:
    """The runs of a plan as arrays, in which many pieces look up their places at once."""

    def __init__(self, runs: list[tuple]):
        runs = sorted(runs)
        self.length, self.low, self.per, _, self.first, self.at, self.cut, self.back = (np.array(c, np.int64) for c in (zip(*runs) if runs else [()] * 8))
        self.lengths, self.begins = np.unique(self.length, return_index=True)

    def run_of(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The last run of ``length`` that begins at ``rank`` or below."""
        k = np.searchsorted(self.lengths, length)
        low, high = self.begins[k], np.append(self.begins[1:], len(self.low))[k]
        while (wide := high - low > 1).any():  # bisection of all at once
            mid = (low + high) // 2
            below = self.low[np.minimum(mid, len(self.low) - 1)] <= rank
            low, high = np.where(wide & below, mid, low), np.where(wide & ~below, mid, high)
        return low

    def of(self, length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(which, start, length, window, offset) of what the pieces of ``length`` and ``rank`` are cut into: first all their first parts, then all second ones."""
        which, start = np.arange(len(length)), np.zeros(len(length), np.int64)
        while len(which):
            k = self.run_of(length, rank)
            i = rank - self.low[k]
            cut = self.cut[k]
            yield which, start, cut, self.first[k] + i // self.per[k], self.at[k] + i % self.per[k] * length
            more = cut < length
            which, start, length, rank = which[more], (start + cut)[more], (length - cut)[more], (self.back[k] + i)[more]


def id_bytes(tokenizer: str, end_id: int = 1) -> int:
    """Bytes that hold any id of a vocabulary: 2 or 4."""
    import json

    spec = json.load(open(tokenizer, encoding="utf-8"))
    top = max([end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return 2 if top < 1 << 16 else 4


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, doc_id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, doc_tokens, start, length, ids): each document's ids, the end id last, as little-endian unsigned integers of ``width`` bytes, cut into windows."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *(T.StructField(n, T.LongType()) for n in ("doc_tokens", "start", "length")), T.StructField("ids", T.BinaryType())])
    end, step = int(end_id).to_bytes(width, "little"), window * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = WordTokenizer.of(tokenizer, width)
        for b in batches:
            keys = b.column(0)
            at, whole, start, parts, size = [], [], [], [], 0

            def batch() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), *(pa.array(x, pa.int64()) for x in (whole, start, [len(p) // width for p in parts])), pa.array(parts, pa.binary())], names=schema.names)

            for i in range(b.num_rows):
                ids = own.encode(b.column(1)[i].as_py()) + end
                for k in range(0, len(ids), step):
                    at.append(i)
                    whole.append(len(ids) // width)
                    start.append(k // width)
                    parts.append(ids[k : k + step])
                    size += len(parts[-1])
                    if size >= BATCH:
                        yield batch()
                        at, whole, start, parts, size = [], [], [], [], 0
            if at:
                yield batch()

    return docs.select(doc_id, text).mapInArrow(run, schema)


def widened(pieces: DataFrame) -> DataFrame:
    """``pieces`` with their ``ids`` of 16 bits as 32 bits."""
    k = pieces.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        WordTokenizer._made.clear()  # this worker may have been a tokenizing one
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                sizes = np.diff(np.frombuffer(part.column(k).buffers()[1], np.int32)[part.column(k).offset :][: part.num_rows + 1])
                ends = np.append(0, np.cumsum(sizes, dtype=np.int64) * 2).astype(np.int32)
                first = int(np.frombuffer(part.column(k).buffers()[1], np.int32)[part.column(k).offset])
                data = part.column(k).buffers()[2]
                ids = np.frombuffer(data, "<u2", int(sizes.sum()) // 2, first).astype("<u4") if sizes.sum() else np.zeros(0, "<u4")
                wide = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([wide if j == k else c for j, c in enumerate(part.columns)], names=part.schema.names)

    return pieces.mapInArrow(run, pieces.schema)


def placed(light: DataFrame, window: int, buckets: int | None = None) -> DataFrame:
    """(_row, _at, _cut, sequence_id, offset) of what each piece of ``light`` (_row, length; written, as it is read twice) is cut into."""
    spark = light.sparkSession
    buckets = buckets or max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
    light = light.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)).cast("int"))
    counted = written(light.groupBy("length", "_bucket").agg(F.count("*").alias("n")), "lengths")
    # At most ``window`` rows, whatever the corpus holds.
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(Places(plan(histogram, window)[0]))
    upto = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    before = counted.select("length", "_bucket", (F.sum("n").over(upto) - F.col("n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_row"))
    # Merged, as counts of a length grow with the buckets: the side has the window's partitions already.
    ranked = light.withColumn("_within", within - 1).join(before.hint("merge"), ["length", "_bucket"]).select("_row", "length", (F.col("_before") + F.col("_within")).cast("long").alias("_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        WordTokenizer._made.clear()  # this worker may have been a tokenizing one
        own = shared.value
        for b in batches:
            row, length, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for which, start, cut, at, offset in own.of(length, rank):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (row[which], start, cut, at, offset)], names=["_row", "_at", "_cut", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "_row long, _at long, _cut long, sequence_id long, offset long")


def pack_cut(cut: DataFrame, window: int = 2048, buckets: int | None = None, width: int = 4) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of ``cut`` (doc_id, doc_tokens, start, length, ids of ``width`` bytes). A piece's ids have 32 bits each."""
    rows = written(cut.withColumn("_row", F.monotonically_increasing_id()), "tokens")
    # Places are a few longs for each piece, and are the side that is hashed; ids are shuffled and not sorted.
    both = rows.join(placed(rows.select("_row", "length"), window, buckets).hint("shuffle_hash"), "_row")
    pieces = both.select("doc_id", (F.col("start") + F.col("_at")).alias("start"), F.col("_cut").alias("length"), F.expr(f"substring(ids, cast({width} * _at + 1 as int), cast({width} * _cut as int))").alias("ids"), "doc_tokens", "sequence_id", "offset")
    return pieces if width == 4 else widened(pieces)


def pack(tokens: DataFrame, window: int = 2048, buckets: int | None = None, width: int = 4) -> DataFrame:
    """Pieces of ``tokens`` (doc_id, doc_tokens, ids of ``width`` bytes), as ``pack_cut`` has them."""
    each = tokens.where("doc_tokens > 0").withColumn("start", F.explode(F.expr(f"sequence(0L, doc_tokens - 1, {window}L)")))
    each = each.withColumn("length", F.least(F.lit(window).cast("long"), F.col("doc_tokens") - F.col("start")))
    return pack_cut(each.select("doc_id", F.col("doc_tokens").cast("long").alias("doc_tokens"), "start", "length", F.expr(f"substring(ids, cast({width} * start + 1 as int), cast({width} * length as int))").alias("ids")), window, buckets, width)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenize ``docs`` once, then pack; every id lies in one piece, and every sequence is filled from offset 0 without gaps."""
    width = id_bytes(tokenizer, end_id)
    return pack_cut(tokenized(docs, tokenizer, end_id, window, doc_id, text, width), window, width=width)
