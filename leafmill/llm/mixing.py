"""Mixing sources to target weights with soft membership.

A classifier learnt from a labelled table gives each document a posterior over
domains. Rates r >= 0, one for each document, are fitted so that the expected
domain totals sum(r n p) meet the targets: least squares with a proximal start
at r = 1, by projected gradient. One step needs the J domain totals at the
current rates and nothing else, so it is one aggregation over short rows, and
the rates themselves are never stored: r is an expression of a row's own
posterior and the residuals so far. The residual is weighted by the inverse of
the posteriors' second moments, which makes the step size 1 safe and the first
step exact where no rate meets its bound.

All in DataFrame operations; the classifier's few weights are fitted on the
driver from a bounded sample of labelled rows and enter as literals.

Cases: a null or empty text has no tokens, gets the posterior of a text without
keywords, and counts nothing towards totals; null labels are passed over, and of
texts that share a labelled id the least is learnt from; without labels there is
one domain and every rate is 1; every labelled domain is one of the model, and a
target for any other is left out with a warning; targets that no nonnegative
rates reach give a warning with the shares reached; of equal posteriors the
first domain by name is named; very long texts are read whole, in slices that cut
no word, so that their words need not be held at once; repeated rows count each; other columns are kept whatever their names; an empty table gives no
rows.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import positional, written

SAMPLE = 3000  #: labelled rows that the classifier learns from
KEYWORDS = 24  #: for each domain
NEAR = 1e-3  #: of all tokens, by which a domain's share may miss its target without a warning
WIDE = 32  #: up to so many domains, expressions name each; beyond, they are over arrays
COLUMNS = 1024  #: of one aggregation
LONG = 1 << 20  #: bytes of a text above which it is read in slices, and code points of a slice
_LETTER = r"\p{L}"


@dataclass(frozen=True)
class Domains:
    names: list[str]
    keywords: list[list[str]]
    weights: list[list[float]]  # for each domain: one for each domain's keyword share, and a constant

    def features(self) -> list[Column]:
        """For each domain, the share of its own among all keywords found (``_hits``)."""

        def share(own: list[str]) -> Column:
            return F.size(F.filter("_hits", lambda w: w.isin(own))) / F.greatest(F.size("_hits"), F.lit(1))

        return [share(k) if k else F.lit(0.0) for k in self.keywords]

    def sliced(self, text: Column) -> Column:
        """The array of ``features`` of a long text: keywords are counted in one slice after the other."""

        def count(hits: Column, own: list[str]) -> Column:
            return F.size(F.filter(hits, lambda w: w.isin(own))) if own else F.lit(0)

        def found(hits: Column) -> Column:
            return F.array(*(count(hits, k) for k in self.keywords), F.size(hits))

        each = F.transform(slices(text), lambda s: once(self.hits(s), found))
        n = F.aggregate(each, F.array(*[F.lit(0)] * (len(self.keywords) + 1)), lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
        last = len(self.keywords)
        return once(n, lambda c: F.array(*(F.get(c, F.lit(i)) / F.greatest(F.get(c, F.lit(last)), F.lit(1)) for i in range(last))))

    def hits(self, text: Column) -> Column:
        words = sorted({w for k in self.keywords for w in k}, key=lambda w: (-len(w), w))
        if not words:
            return F.array().cast("array<string>")
        pattern = rf"(?<!{_LETTER})(?:{'|'.join(words)})(?!{_LETTER})"  # letters only
        return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(pattern), 0), F.array().cast("array<string>"))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def is_long(text: Column) -> Column:
    return F.coalesce(F.octet_length(text) > LONG, F.lit(False))


def slices(text: Column) -> Column:
    """A text in parts of ``LONG`` code points at most, each cut before white space; only a longer word makes a longer part."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{LONG}}}(?=\s|\z)|\S+"), F.lit(0))


def tokens(text: Column) -> Column:
    """Words between white space, as the measure of a document's size."""

    def count(of: Column) -> Column:
        return F.regexp_count(of, F.lit(r"\S+"))

    parts = F.aggregate(F.transform(slices(text), count), F.lit(0), lambda a, b: a + b)
    return F.coalesce(F.when(is_long(text), parts).otherwise(count(text)), F.lit(0)).cast("long")


def featured(docs: DataFrame, model: Domains, text: str) -> DataFrame:
    """``docs`` with ``_x``, an array of the model's features, and ``_hits``, which they are counted in unless a text is long."""
    out = docs.withColumn("_hits", model.hits(F.when(~is_long(F.col(text)), F.col(text))))
    return out.withColumn("_x", F.when(is_long(F.col(text)), model.sliced(F.col(text))).otherwise(F.array(*model.features())))


def fit_domains(docs: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "domain", sample: int = SAMPLE) -> Domains:
    """``labelled``: (doc_id, label). Learns from the ``sample`` rows of smallest hash, and one row of each domain."""
    known = written(labelled.where(F.col(label).isNotNull()).groupBy(doc_id).agg(F.min(F.col(label).cast("string")).alias("_y")), "known")
    each = known.groupBy("_y").agg(F.min(F.struct(F.xxhash64(doc_id).alias("h"), F.col(doc_id).alias("d"))).alias("s")).select(F.col("s.d").alias(doc_id), "_y")
    chosen = known.orderBy(F.xxhash64(doc_id), doc_id).limit(sample).unionByName(each).distinct()
    # One text for each chosen id, however often the id is repeated.
    rows = docs.select(doc_id, text).join(F.broadcast(chosen), doc_id).groupBy(doc_id, "_y").agg(F.min(F.lower(F.coalesce(F.col(text), F.lit("")))).alias("text"))
    rows = written(rows.select("text", "_y"), "labelled")
    names = sorted({r[0] for r in rows.select("_y").distinct().collect()})
    if len(names) < 2:
        return Domains(names or ["all"], [[]], [[0.0, 0.0]])
    apart = rf"[^{_LETTER}]+"
    in_slices = F.aggregate(slices(F.col("text")), F.array().cast("array<string>"), lambda a, s: F.array_union(a, F.split(s, apart)))
    words = F.when(is_long(F.col("text")), in_slices).otherwise(F.array_distinct(F.split("text", apart)))
    each = rows.select("_y", F.explode_outer(words).alias("w")).where(F.col("w").rlike(f"^{_LETTER}{{1,20}}$"))
    size = {r["_y"]: r["count"] for r in rows.groupBy("_y").count().collect()}
    by_word = [F.count(F.when(F.col("_y") == y, 1)).alias(f"n{i}") for i, y in enumerate(names)]
    counts = each.groupBy("w").agg(*by_word)
    total = sum(size.values())
    keywords = []
    for i, y in enumerate(names):  # the words whose documents lean most to this domain
        own, rest = F.col(f"n{i}"), sum((F.col(f"n{k}") for k in range(len(names)) if k != i), F.lit(0))
        lean = (own / size[y]) * F.log((own + 0.5) / (size[y] + 1) / ((rest + 0.5) / (total - size[y] + 1)))
        keywords.append([r["w"] for r in counts.select("w", lean.alias("s")).where("s > 0").orderBy(F.desc("s"), "w").limit(KEYWORDS).collect()])
    model = Domains(names, keywords, [])
    found = featured(rows, model, "text").select("_y", F.col("_x").alias("x")).collect()
    x = np.hstack([np.array([r["x"] for r in found], float), np.ones((len(found), 1))])
    y = np.array([[float(r["_y"] == n) for n in names] for r in found])
    w = np.zeros((len(names), x.shape[1]))
    for _ in range(400):  # multinomial logistic regression
        z = x @ w.T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w += 2.0 * ((y - p).T @ x / len(x) - 1e-4 * w)
    return Domains(names, keywords, [[float(v) for v in row] for row in w])


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def posteriors(docs: DataFrame, model: Domains, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``posterior``, an array over ``model.names``."""
    out = featured(docs, model, text)
    if len(model.weights) > WIDE:
        weights = F.from_json(F.lit(json.dumps(model.weights)), "array<array<double>>")
        out = out.withColumn("_z", F.transform(weights, lambda w: F.exp(total(F.zip_with(F.concat(F.col("_x"), F.array(F.lit(1.0))), w, lambda a, b: a * b)))))
        out = out.withColumn("_t", total(F.col("_z")))
        return out.withColumns({"n_tokens": tokens(F.col(text)), "posterior": F.transform("_z", lambda z: z / F.col("_t"))}).drop("_hits", "_x", "_z", "_t")
    scores = [sum((F.get("_x", F.lit(j)) * w for j, w in enumerate(row[:-1])), F.lit(0.0)) + row[-1] for row in model.weights]
    out = out.withColumn("_z", F.array(*(F.exp(s) for s in scores)))
    out = out.withColumn("_t", sum((F.get("_z", F.lit(j)) for j in range(len(scores))), F.lit(0.0)))
    return out.withColumns({"n_tokens": tokens(F.col(text)), "posterior": F.array(*(F.get("_z", F.lit(j)) / F.col("_t") for j in range(len(scores))))}).drop("_hits", "_x", "_z", "_t")


def rate(steps: list[list[float]], posterior: Column) -> Column:
    """The rate after projected steps r = max(0, r - posterior . step) from 1."""
    r = F.lit(1.0)
    for s in steps:
        if len(s) > WIDE:
            step = F.from_json(F.lit(json.dumps([float(v) for v in s])), "array<double>")
            r = F.greatest(F.lit(0.0), r - total(F.zip_with(posterior, step, lambda a, b: a * b)))
            continue
        r = F.greatest(F.lit(0.0), r - sum((F.get(posterior, F.lit(j)) * float(v) for j, v in enumerate(s)), F.lit(0.0)))
    return r


def tempered(shares: np.ndarray, power: float = 0.7) -> np.ndarray:
    """Targets between the natural shares and equal ones."""
    t = np.power(shares, power)
    return t / t.sum()


def fit_rates(rows: DataFrame, names: list[str], targets: dict[str, float] | None = None, rounds: int = 20, tolerance: float = 1e-6) -> tuple[list[list[float]], np.ndarray, np.ndarray]:
    """(steps for ``rate``, targets, shares reached) over ``rows`` (n_tokens, posterior), written as it is read each round. Totals are shares of the tokens there are."""
    j = len(names)
    p = [F.get("posterior", F.lit(i)) for i in range(j)]
    if targets is not None and (unknown := sorted(n for n, v in targets.items() if v and n not in names)):
        warnings.warn(f"targets of domains without labelled rows are left out: {', '.join(unknown)}", stacklevel=2)
    sums = [F.sum("n_tokens"), *(F.sum(F.col("n_tokens") * a) for a in p), *(F.sum(F.col("n_tokens") * a * b) for a in p for b in p)]
    step = COLUMNS + 1 + WIDE  # one aggregation up to WIDE domains
    first = [v for i in range(0, len(sums), step) for v in rows.agg(*sums[i : i + step]).first()]
    whole = float(first[0] or 0)
    if not whole:
        return [], np.full(j, 1.0 / j), np.zeros(j)
    at = np.array(first[1 : 1 + j], float) / whole
    moments = np.array(first[1 + j :], float).reshape(j, j) / whole
    goal = tempered(at) if targets is None else np.array([targets.get(n, 0.0) for n in names])
    goal = goal / goal.sum()
    weight = np.linalg.inv(moments + 1e-9 * np.eye(j))
    steps: list[list[float]] = []
    while np.abs(at - goal).max() >= tolerance and len(steps) < rounds:
        steps.append((weight @ (at - goal)).tolist())
        r = rate(steps, F.col("posterior"))
        at = np.array(rows.select(r.alias("r"), "n_tokens", "posterior").agg(*(F.sum(F.col("n_tokens") * F.col("r") * a) for a in p)).first(), float) / whole
    if (off := np.abs(at - goal).max()) > NEAR:
        worst = int(np.abs(at - goal).argmax())
        warnings.warn(f"targets are missed by up to {off:.4f} after {len(steps)} rounds: {names[worst]} has {at[worst]:.4f} for {goal[worst]:.4f}", stacklevel=2)
    return steps, goal, at


def copies(r: Column, key: Column, seed: int = 9) -> Column:
    """How often a document is taken: its rate, rounded up or down by a hash of its key so that the mean is kept."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double")) * F.lit(2.0**-53)
    return (F.floor(r) + (u < r - F.floor(r)).cast("int")).cast("int")


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "domain") -> DataFrame:
    """(doc_id, n_tokens, domain, posterior, rate, copies) of every row."""
    model = fit_domains(docs, labelled, doc_id, text, label)
    rows = written(posteriors(docs.select(doc_id, text), model, text).select(doc_id, "n_tokens", "posterior"), "posteriors")
    steps, _, _ = fit_rates(rows, model.names, targets)
    names = F.array(*map(F.lit, model.names))
    out = rows.withColumns({"rate": rate(steps, F.col("posterior")), "domain": F.get(names, F.array_position("posterior", F.array_max("posterior")).cast("int") - 1)})
    return out.select(doc_id, "n_tokens", "domain", "posterior", "rate", copies(F.col("rate"), F.col(doc_id)).alias("copies"))


def resampled(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "domain") -> DataFrame:
    """``docs`` with each row as often as its rate says."""
    model = fit_domains(docs, labelled, doc_id, text, label)
    named = positional(docs)
    at = dict(zip(docs.columns, named.columns))
    # Texts are read for keywords once: rows are written with their posteriors, and both the fit and the resampling read that.
    rows = written(posteriors(named, model, at[text]), "posteriors")
    steps, _, _ = fit_rates(rows.select("n_tokens", "posterior"), model.names, targets)
    n = copies(rate(steps, F.col("posterior")), F.col(at[doc_id]))
    taken = rows.select(*named.columns, n.alias("_copies")).where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return taken.select(named.columns).toDF(*docs.columns)
