"""Document quality from a linear-chain conditional random field over lines.

Every line of a whole text is labelled good or bad by a two-state chain whose
unary features describe the line and its two neighbours, and whose transition
weights carry a label on to the next line. Forward-backward gives each line's
marginal; the marginals, weighted by line length, make the document's quality,
which a one-dimensional logistic maps to the labels' scale.

Labels are of documents, so training starts with every line taking its
document's label, and then lets good-looking lines of bad documents change
sides. It sees a bounded sample: the ``sample`` labelled documents of smallest
hash, or fewer where these have more than ``TRAINED`` lines, each with all its
lines; chains longer than ``LINES`` are trained in runs of that many. Scoring
reads all lines of all rows as one chain each. The doc_id decides only which
rows may be learnt from; lang and source are unused.

Cases: a null or empty text is one empty line; null labels are passed over,
contradicting ones averaged; without labels of both kinds every score is 0.5;
repeated rows are scored each; of texts that share a labelled doc_id the least
is learnt from; a null doc_id counts as held out; very long texts are scored
whole; other columns pass through whatever their names; an empty table gives no
rows.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import positional, written

LINES = 64  #: lines of a run that training handles at once
SAMPLE = 2000  #: labelled documents used in training, at most
TRAINED = 500_000  #: lines of these, at most, but for the first document
THRESHOLD = 0.3

WIDTH = 13
_KINDS = 8  # letter, capital, digit, odd, mark, bar, shout, white space
_ENDS = tuple(".!?:\"')]")


def _kinds() -> np.ndarray:
    """A bit for each kind of each code point of the basic plane."""
    out = np.zeros(65537, np.uint8)
    for c in range(65536):
        g, ch = unicodedata.category(chr(c)), chr(c)
        out[c] = (g[0] == "L") | (g in ("Lu", "Lt")) << 1 | (g == "Nd") << 2 | (ch in "#$%&*~^=<>{}[]\\@_+") << 3 | (ch in ".,;:?'\"()-") << 4 | (ch == "|") << 5 | (ch == "!") << 6 | ch.isspace() << 7
    out[65536] = 1
    return out


_TABLE: list[np.ndarray] = []


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines, WIDTH) values and the lines' lengths of one text, in time in proportion to its length."""
    if not _TABLE:
        _TABLE.append(_kinds())
    lines = text.split("\n")
    k = len(lines)
    code = np.frombuffer((text + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _TABLE[0][np.minimum(code, 65536)]
    cut = np.flatnonzero(code == 10)
    first = np.append(0, cut[:-1] + 1)
    n = (cut - first).astype(float)
    # The line's own line feed is white space, and counts in nothing but that.
    sums = [np.add.reduceat(kind >> i & 1, first, dtype=np.int64).astype(float) for i in range(_KINDS - 1)]
    space = kind >> 7 & 1
    starts = np.append(1, space[:-1]) & (1 - space)
    words = np.maximum(1, np.add.reduceat(starts, first, dtype=np.int64))
    letters, capitals, digits, odd, marks, bars, shouts = sums
    size = np.maximum(1, n)
    out = np.zeros((k, WIDTH))
    out[:, 0] = n == 0
    out[:, 1] = np.log1p(n) / 5
    out[:, 2] = letters / size
    out[:, 3] = capitals / np.maximum(1, letters)
    for i, (x, times) in enumerate(((digits, 4), (odd, 8), (marks, 8), (bars, 8), (shouts, 8)), 4):
        out[:, i] = np.minimum(1, times * x / size)
    out[:, 9] = [s.rstrip().endswith(_ENDS) for s in lines]
    out[:, 10] = np.minimum(2, n / words / 10)
    out[:, 11] = np.fromiter((len(set(s.split())) for s in lines), float, k) / words
    if len(set(lines)) < k:
        seen: set[str] = set()
        for i, s in enumerate(lines):
            out[i, 12] = bool(s) and s in seen
            seen.add(s)
    out[n == 0, 9:] = 0
    return out, n + 1


def with_neighbours(x: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features, flags for the ends, and a constant."""
    n = len(x)
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    ends = np.zeros((n, 3))
    ends[0, 0] = ends[-1, 1] = 1
    ends[:, 2] = 1
    return np.hstack([x, before, after, ends])


@dataclass(frozen=True)
class Model:
    unary: np.ndarray  # weight of state 1 (good); state 0 has none
    chain: np.ndarray  # (2, 2) transition weights
    scale: tuple[float, float]

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """P(good) of each line, by forward-backward in log space."""
        t = np.exp(self.chain - self.chain.max())
        (t00, t01), (t10, t11) = t.tolist()
        g = (1 / (1 + np.exp(-np.clip(x @ self.unary, -30, 30)))).tolist()
        fwd, f = [], 0.5
        for i, e in enumerate(g):  # f: P(good) given the lines so far
            a, b = ((1 - f) * t00 + f * t10, (1 - f) * t01 + f * t11) if i else (1.0, 1.0)
            f = b * e / (a * (1 - e) + b * e)
            fwd.append(f)
        out, b0, b1 = [0.0] * len(g), 1.0, 1.0
        for i in range(len(g) - 1, -1, -1):
            f, e = fwd[i], g[i]
            out[i] = f * b1 / ((1 - f) * b0 + f * b1)
            b0, b1 = t00 * (1 - e) * b0 + t01 * e * b1, t10 * (1 - e) * b0 + t11 * e * b1
            z = b0 + b1
            b0, b1 = b0 / z, b1 / z
        return np.array(out)

    def score(self, text: str | None) -> float:
        x, weight = line_features(text or "")
        p = self.marginals(with_neighbours(x))
        return self.calibrated(float((p * weight).sum() / weight.sum()))

    def calibrated(self, quality: float) -> float:
        return float(1 / (1 + np.exp(-(self.scale[0] * quality + self.scale[1]))))


def forward_backward(u: np.ndarray, lengths: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of lines' unary scores ``u`` (rows, lines): P(good) of each line, and each row's expected transition counts (rows, 2, 2)."""
    rows, n = u.shape
    t = np.exp(chain - chain.max())
    e = np.stack([np.ones_like(u), np.exp(np.clip(u, -30, 30))], axis=2)
    e /= e.sum(axis=2, keepdims=True)
    live = np.arange(n)[None, :] < lengths[:, None]
    fwd, bwd = np.ones((rows, n, 2)), np.ones((rows, n, 2))
    fwd[:, 0] = e[:, 0]
    fwd[:, 0] /= fwd[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, n):
        v = (fwd[:, i - 1] @ t) * e[:, i]
        fwd[:, i] = v / v.sum(axis=1, keepdims=True)
    for i in range(n - 2, -1, -1):
        v = (bwd[:, i + 1] * e[:, i + 1]) @ t.T
        bwd[:, i] = np.where(live[:, i + 1, None], v / v.sum(axis=1, keepdims=True), 1.0)
    p = fwd * bwd
    p /= p.sum(axis=2, keepdims=True)
    pairs = fwd[:, :-1, :, None] * t[None, None] * (e[:, 1:] * bwd[:, 1:])[:, :, None, :]
    pairs /= np.maximum(pairs.sum(axis=(2, 3), keepdims=True), 1e-300)
    return p[:, :, 1], (pairs * live[:, 1:, None, None]).sum(axis=1)


def train(docs: list[tuple[np.ndarray, np.ndarray, float]], steps: int = 80, rounds: int = 2) -> Model | None:
    """``docs``: (line features with neighbours, line weights, label) of each; None without labels of both kinds."""
    labels = np.array([y for *_, y in docs])
    if not len(docs) or labels.min() == labels.max():
        return None
    runs = [(i, f[k : k + LINES], w[k : k + LINES]) for i, (f, w, _) in enumerate(docs) for k in range(0, len(f), LINES)]
    of = np.array([i for i, *_ in runs])
    n = max(len(f) for _, f, _ in runs)
    x = np.zeros((len(runs), n, docs[0][0].shape[1]))
    weight, lengths = np.zeros((len(runs), n)), np.array([len(f) for _, f, _ in runs])
    for i, (_, f, w) in enumerate(runs):
        x[i, : len(f)], weight[i, : len(f)] = f, w
    live = np.arange(n)[None, :] < lengths[:, None]
    good = labels[of]
    share = np.where(labels > 0.5, 0.5 / max(1, (labels > 0.5).sum()), 0.5 / max(1, (labels <= 0.5).sum()))  # both kinds count alike
    share = (share / np.bincount(of, lengths))[of]
    goal = np.where(live, good[:, None], 0.0)
    unary, chain = np.zeros(x.shape[2]), np.zeros((2, 2))
    for r in range(rounds):
        m, v, mc, vc = np.zeros_like(unary), np.zeros_like(unary), np.zeros((2, 2)), np.zeros((2, 2))
        want = np.stack([1 - goal, goal], axis=2)
        seen = (want[:, :-1, :, None] * want[:, 1:, None, :] * live[:, 1:, None, None]).sum(axis=1)
        for k in range(1, steps + 1):
            p, pairs = forward_backward(x @ unary, lengths, chain)
            g = np.einsum("dl,dlf->f", (goal - p) * live * share[:, None], x) - 1e-4 * unary
            gc = ((seen - pairs) * share[:, None, None]).sum(axis=0) - 1e-4 * chain
            m, v, mc, vc = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mc + 0.1 * gc, 0.99 * vc + 0.01 * gc * gc
            step = 0.1 * np.sqrt(1 - 0.99**k) / (1 - 0.9**k)
            unary, chain = unary + step * m / (np.sqrt(v) + 1e-9), chain + step * mc / (np.sqrt(vc) + 1e-9)
        p, _ = forward_backward(x @ unary, lengths, chain)
        if r < rounds - 1:
            goal = np.where(live & ((good[:, None] > 0.5) | (p > 0.8)), 1.0, 0.0)
    quality = np.bincount(of, (p * weight).sum(axis=1)) / np.bincount(of, weight.sum(axis=1))
    a, b = 1.0, 0.0
    z = np.stack([quality, np.ones_like(quality)], axis=1)
    for _ in range(50):  # Newton's method
        q = 1 / (1 + np.exp(-np.clip(a * quality + b, -30, 30)))
        h = (z * (q * (1 - q))[:, None]).T @ z + 1e-3 * np.eye(2)
        d = np.linalg.solve(h, z.T @ (labels - q) - 1e-3 * np.array([a, b]))
        a, b = a + float(np.clip(d[0], -5, 5)), b + float(np.clip(d[1], -5, 5))
    return Model(unary, chain, (a, b))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """Learns from ``labels`` (doc_id, label) whose crc32(doc_id as text) mod 5 is not 0."""
    known = (
        labels.where(F.col(label).isNotNull() & (F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0))
        .groupBy(doc_id)
        .agg(F.avg(F.col(label).cast("double")).alias("_y"))
        .orderBy(F.xxhash64(doc_id), doc_id)
        .limit(sample)
    )
    # One text for each labelled id, however often the id is repeated: ``sample`` rows at most.
    rows = docs.select(doc_id, text).join(F.broadcast(known), doc_id).groupBy(doc_id, "_y").agg(F.min(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    rows = written(rows.select(F.xxhash64(doc_id).alias("_h"), "_y", "_text"), "labelled")
    upto, lines = None, 0
    for r in rows.select("_h", (F.regexp_count("_text", F.lit("\n")) + 1).alias("lines")).orderBy("_h").collect():
        lines += r["lines"]
        if upto is not None and lines > TRAINED:
            break
        upto = r["_h"]
    schema = T.StructType([T.StructField("x", T.BinaryType()), T.StructField("w", T.BinaryType()), T.StructField("y", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t, y in zip(b.column(0), b.column(1)):
                x, w = line_features(t.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([x.astype("<f4").tobytes()], pa.binary()), pa.array([w.astype("<f4").tobytes()], pa.binary()), pa.array([y.as_py()], pa.float64())], names=schema.names)

    rows = rows.where(F.col("_h") <= upto).select("_text", "_y").mapInArrow(run, schema).collect() if upto is not None else []
    found = [(with_neighbours(np.frombuffer(r["x"], "<f4").reshape(-1, WIDTH).astype(float)), np.frombuffer(r["w"], "<f4").astype(float), r["y"]) for r in rows]
    return train(sorted(found, key=lambda f: (f[2], len(f[0]), f[0].sum())))


def score(docs: DataFrame, model: Model | None, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text in ``column``; other columns pass through unread."""
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            own = [0.5 if m is None else m.score(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def kept(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that score below ``threshold``."""
    rows = positional(docs)
    scored = score(rows, model, rows.columns[docs.columns.index(text)], "_score")
    return scored.where(F.col("_score") >= threshold).drop("_score").toDF(*docs.columns)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fold(doc_id) -> int:
    """The remainder that ``held_out`` tests, in Python."""
    return zlib.crc32(str(doc_id).encode()) % 5
