"""Fingerprints, secret scans, quality and mixing: brute force, planted cases, held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import fingerprints as P
from leafmill.llm import mixing as M
from leafmill.llm import quality as Y
from leafmill.llm import queries as Q
from leafmill.llm import secrets as X

# --- fingerprints -------------------------------------------------------------------------------------------------------------------------------


def words(text):
    out, now = Counter(), ""
    for c in (text or "").lower() + " ":
        if c in " \t\n\x0b\x0c\r":
            if now:
                out[now] += 1
            now = ""
        else:
            now += c
    return out


def jaccard(a, b):
    a, b = words(a), words(b)
    top = sum((a | b).values())
    return sum((a & b).values()) / top if top else 1.0


def edited(rows):
    """(doc_id, text, edited, next) by the contract, over distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        yield i, t, t[: len(t) - half] + after[:half], after


def test_op6(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = {r["doc_id"]: r for r in Q.op6_fingerprints(spark, sf).collect()}
    assert len(found) == len(rows)
    errors, prints = [], {}
    for i, text, new, after in edited(rows):
        r = found[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        errors += [r["near_edited"] - jaccard(text, new), r["near_next"] - jaccard(text, after)]
        if text == after:
            assert r["near_next"] == 1
    assert abs(np.mean(errors)) < 0.02 and np.sqrt(np.mean(np.square(errors))) < 0.09


def test_collision_rate_is_generalised_jaccard(spark):
    rng = random.Random(3)
    texts = [" ".join(w for k in range(12) for w in [f"w{k}"] * rng.randint(0, 6)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    prints = {r["k"]: r["fingerprint"] for r in P.signed(df, ["k"], "t", 256).collect()}
    assert set(prints) == set(range(40)) and all(len(p) == 1024 for p in prints.values())
    errors = []
    for i in range(40):
        for j in range(i):
            same = np.mean([prints[i][4 * k : 4 * k + 4] == prints[j][4 * k : 4 * k + 4] for k in range(256)])
            errors.append(same - jaccard(texts[i], texts[j]))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_fingerprints_of_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, "A b"), (4, "a  B"), (4, "a  B"), (None, "x"), (9, "é" * 7), (10, "word " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("bucket", "rn", "fingerprint", "side"):
        df = df.withColumn(name, F.lit("x"))
    found = P.fingerprint_documents(df).collect()
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append(r)
    assert sorted(len(v) for v in by.values()) == [1, 1, 1, 1, 1, 1, 2]
    assert by[1][0]["fingerprint"] == by[2][0]["fingerprint"] == "0" * 256 and by[3][0]["fingerprint"] == by[4][0]["fingerprint"] == by[4][1]["fingerprint"]
    assert by[10][0]["n_chars"] == 150_000 and by[9][0]["edited_sha256"] == hashlib.sha256(("é" * 4 + "a  ").encode()).hexdigest()
    assert by[None][0]["edited_sha256"] == hashlib.sha256(b"x").hexdigest()
    one = P.fingerprint_documents(df.where("doc_id = 3")).first()
    assert one["near_next"] == 1 and P.fingerprint_documents(df.limit(0)).count() == 0


# --- secret scans -------------------------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trees(spark):
    return X.fit(spark)


def test_forest_on_findings_it_has_not_seen(spark, trees):
    rows = X.labelled_findings(1600, seed=99)
    df = X.local_rows(spark, rows, "before string, tok string, after string, path string, label int")
    p = df.select(F.expr("label"), X.features(F.col("tok"), F.col("before"), F.col("after"), F.col("path")).alias("v")).withColumn("p", F.expr(X.compiled(trees, "v"))).collect()
    found, label = np.array([r["p"] >= 0.5 for r in p]), np.array([r["label"] == 1 for r in p])
    assert (found & label).sum() / label.sum() > 0.95 and (found & label).sum() / found.sum() > 0.95


def test_planted_secrets(spark, trees):
    key, hexes = "AKIA" + "QX7RZT2LMW4PB6YN", "9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c"
    texts = [f"plain words. api_key = {hexes} and more", f"use {key} there", "order 123456789012 of 2024-10-11T10:20:00", f"commit {hexes} fixed it", None, "", "word " * 5000, "uuid 123e4567-e89b-12d3-a456-426614174000 here"]
    df = spark.createDataFrame([(i, t, "src1") for i, t in enumerate(texts)] + [(0, texts[0], "src1")], "doc_id long, text string, source string")
    found = sorted((r["doc_id"], r["start"], r["length"], r["secret"]) for r in X.findings(df, trees).collect())
    assert found == sorted([(0, texts[0].index(hexes), 40, hexes)] * 2 + [(1, 4, len(key), key)])
    for name in ("_pieces", "_found", "_p", "_x", "_row", "secret"):
        df = df.withColumn(name, F.lit("kept"))
    clean = {r["doc_id"]: r for r in X.redacted(df, trees).collect()}
    assert hexes not in clean[0]["text"] and "plain words. api_key = [SECRET] and more" == clean[0]["text"] and clean[0]["_found"] == "kept"
    assert all(clean[i]["text"] == texts[i] for i in range(2, len(texts)))
    assert X.redacted(df, trees).columns == df.columns and X.redacted(df.limit(0), trees).count() == 0 == X.findings(df.limit(0), trees).count()


NAMED = [
    ("DB_PASSWORD=", "Tr0ub4dor!", ""), ("Password: ", "hunter2x", ""), ('API_KEY="', "k3yV4lue9", '"'), ('secret_key = "', "QwErTyUiOpAsDfGhJkLz", '"'), ("TOKEN = \"", "ABCDEFGHIJKLMNOPQRSTUV", '"'), ("private_key: ", "abcdefghijkl", ""),
    ("Authorization: Bearer ", "abcdefghijklmnopqrstuv", ""), ('password="', "P@ss$word99", '"'), ('password="', "abc123x$yZ9!kk", '"'), ("pwd='", "a,b;c(d)e 7", "'"), ("token=", "ab#1$c%9*|x,y;z", "&user=bob"), ('"token": "', "a1\\\"b2c3d4", '"'),
]


def test_candidates_after_names_are_whole(spark, trees):
    df = spark.createDataFrame([(i, f"some words {a}{b}{c} and more") for i, (a, b, c) in enumerate(NAMED)], "doc_id long, text string")
    rows = {r["doc_id"]: r["_found"] for r in X.scanned(df, trees).collect()}
    assert rows == {i: [b] for i, (_, b, _) in enumerate(NAMED)}
    clean = {r["doc_id"]: r["text"] for r in X.redacted(df, trees).collect()}
    for i in (0, 2, 3, 7, 8):
        a, _, c = NAMED[i]
        assert clean[i] == f"some words {a}{X.PLACEHOLDER}{c} and more"


def test_findings_lie_where_they_say(spark):
    path = "/root/testdata/sf0.01"  # the smallest table has no secrets
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()}
    found = Q.op7_secrets(spark, path).collect()
    assert found and all(texts[r["doc_id"]][r["start"] : r["start"] + r["length"]] == r["secret"] for r in found)


def test_compiled_trees_agree_with_walking_them(spark, trees):
    rng = np.random.default_rng(2)
    x = rng.uniform(0, 3, (50, len(X.FEATURES)))

    def walk(t, v):
        return t if isinstance(t, float) else walk(t[2] if v[t[0]] <= t[1] else t[3], v)

    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>")
    found = [r[0] for r in df.orderBy("i").select(F.expr(X.compiled(trees, "v"))).collect()]
    assert np.allclose(found, [np.mean([walk(t, v) for t in trees]) for v in x], atol=1e-5)


# --- quality ------------------------------------------------------------------------------------------------------------------------------------


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(1)
    chain, unary = rng.standard_normal((2, 2)), rng.standard_normal(3)
    x = rng.standard_normal((5, 3))
    model = Y.Model(unary, chain, (1.0, 0.0))
    total, good, pairs = 0.0, np.zeros(5), np.zeros((2, 2))
    for k in range(32):
        y = [k >> i & 1 for i in range(5)]
        w = np.exp(sum(x[i] @ unary for i in range(5) if y[i]) + sum(chain[y[i], y[i + 1]] for i in range(4)))
        total += w
        good += w * np.array(y)
        for i in range(4):
            pairs[y[i], y[i + 1]] += w
    assert np.allclose(model.marginals(x), good / total)
    p, found = Y.forward_backward((x @ unary)[None], np.array([5]), chain)
    assert np.allclose(p[0], good / total) and np.allclose(found[0], pairs / total)


def test_line_features_of_any_text():
    for text in ("", "\n", "a\n\nB\n", "x" * 100_000, "é\n" * 5000, "\ud800", "😀|!\t"):
        x, w = Y.line_features(text)
        assert len(x) == len(w) == text.count("\n") + 1 and np.isfinite(x).all() and w.sum() == len(text) + 1


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    for v in np.unique(scores):
        own = np.flatnonzero(np.asarray(scores) == v)
        ranks[own] = np.mean([np.flatnonzero(order == i)[0] for i in own]) + 1
    ones = np.asarray(labels) == 1
    return (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_op10_on_held_out_documents(spark):
    path = "/root/testdata/sf0.1"
    found = {r["doc_id"]: r for r in Q.op10_quality(spark, path).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{path}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in found.items())
    own = [i for i in labels if i in found and found[i]["held_out"] and labels[i] is not None]
    y = [labels[i] for i in own]
    assert auc([found[i]["score"] for i in own], y) > 0.95
    assert np.mean([found[i]["predicted"] == labels[i] for i in own]) > 0.93
    assert np.mean([found[i]["predicted"] for i in own if labels[i] == 1]) > 0.97


def test_quality_of_odd_tables(spark):
    rows = [(i, "A plain sentence stands here.\nAnother one follows it." if i % 2 else "$$## 1|2|3 !!\n@@ == ## 99") for i in range(60)] + [(61, None), (62, ""), (None, "A line."), (1, "A plain sentence stands here.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, None), (None, 1)], "doc_id long, quality int")
    model = Y.fit(df, labels)
    found = Y.score(df.withColumn("_score", F.lit("x")), model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["_score"] == "x" for r in found)
    assert min(r["score"] for r in found if r["doc_id"] is not None and r["doc_id"] < 60 and r["doc_id"] % 2) > max(r["score"] for r in found if r["doc_id"] is not None and r["doc_id"] < 60 and not r["doc_id"] % 2)
    assert Y.fit(df, labels.where("quality = 1")) is None and {r["score"] for r in Y.score(df, None).collect()} == {0.5}
    assert Y.score(df.limit(0), model).count() == 0 and Y.fit(df.limit(0), labels) is None


# --- mixing -------------------------------------------------------------------------------------------------------------------------------------


def test_quality_learns_from_all_lines_and_one_text_of_an_id(spark):
    good, bad = "A plain sentence stands on this line, and it ends.", "CLICK!!! 55 ||| $$$ WIN"
    rows = [(i, "\n".join([good] * 500)) for i in range(1, 40, 2)] + [(i, "\n".join([good] * 400 + [bad] * 100)) for i in range(2, 40, 2)]
    docs = spark.createDataFrame(rows + [(1, rows[0][1])] * 5, "doc_id long, text string").unionByName(spark.range(20_000).select(F.lit(3).cast("long").alias("doc_id"), F.lit(good).alias("text")))
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    model = Y.fit(docs, labels)
    line = model.marginals(Y.with_neighbours(Y.line_features("\n".join([good] * 20 + [bad] * 20))[0]))
    assert line[:15].mean() > 0.5 > line[-15:].mean() and model.score(rows[0][1]) > model.score(rows[-1][1])


def test_posteriors_know_the_languages(spark):
    path = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text", "lang")
    model = M.fit_domains(docs, Q.domains(spark, path))
    rows = M.posteriors(docs, model).select("lang", "n_tokens", F.array_max("posterior").alias("m"), F.expr("array_position(posterior, array_max(posterior))").alias("at")).collect()
    assert model.names == ["de", "en", "es", "fr"]
    assert np.mean([model.names[int(r["at"]) - 1] == r["lang"] for r in rows if r["n_tokens"] > 20]) > 0.97


@pytest.mark.parametrize("targets", [None, {"en": 0.25, "de": 0.25, "es": 0.25, "fr": 0.25}, {"en": 1.0}, {"de": 0.9, "xx": 0.1}])
def test_rates_meet_targets(spark, sf, targets):
    found = M.mixed(spark.read.parquet(f"{sf}/documents.parquet"), Q.domains(spark, sf), targets).collect()
    names = ["de", "en", "es", "fr"]
    p, n, r = np.array([x["posterior"] for x in found]), np.array([x["n_tokens"] for x in found], float), np.array([x["rate"] for x in found])
    assert len(found) == 200 and (r >= 0).all() and np.allclose(p.sum(axis=1), 1)
    share = (n * r) @ p / (n @ p).sum()
    goal = np.array([(targets or {}).get(k, 0.0) for k in names]) if targets else M.tempered(n @ p / n.sum())
    # A soft posterior bounds what can be met: a domain with target 0 keeps what other domains' documents are believed to hold of it.
    assert np.abs(share - goal / goal.sum()).max() < (1e-4 if not targets or len(targets) == 4 else 0.05)
    copies = np.array([x["copies"] for x in found])
    assert (np.abs(copies - r) < 1).all()


def test_least_squares_has_no_better_rates(spark, sf):
    found = M.mixed(spark.read.parquet(f"{sf}/documents.parquet"), Q.domains(spark, sf), {"en": 1.0}).collect()
    p, n, r = np.array([x["posterior"] for x in found]), np.array([x["n_tokens"] for x in found], float), np.array([x["rate"] for x in found])
    goal, total = np.array([0.0, 1.0, 0.0, 0.0]), (n @ p).sum()

    def loss(rates):
        return float((((n * rates) @ p / total - goal) ** 2).sum())

    step = r.copy()
    for _ in range(3000):
        g = 2 * (p @ ((n * step) @ p / total - goal)) * n / total
        step = np.maximum(0, step - g / (2 * ((n / total) ** 2).sum()))
    assert loss(r) <= loss(step) + 1e-3


def test_every_domain_of_many_meets_its_target(spark):
    names = [f"d{k:02d}" for k in range(40)]
    rows = [(k * 20 + i, f"{chr(97 + k % 26) * (4 + k // 26)} " * 10, n) for k, n in enumerate(names) for i in range(40 if k < 2 else 20)]
    rows = [(i, text, n) for i, (_, text, n) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    targets = {n: 1.0 + (k >= 35) for k, n in enumerate(names)}
    got: dict = {}
    for r in M.mixed(df, df, targets).collect():
        got[r["domain"]] = got.get(r["domain"], 0.0) + r["rate"] * r["n_tokens"]
    whole = sum(targets.values())
    assert set(got) == set(names) and all(abs(got[n] / sum(got.values()) - targets[n] / whole) < 0.3 * targets[n] / whole for n in names)
    with pytest.warns(UserWarning, match="nowhere"):
        M.mixed(df, df, {"d00": 1.0, "nowhere": 1.0})


def test_mixing_of_odd_tables(spark):
    rows = [(i, ("the and of to " if i % 2 else "der die das und ") * 20, "a.b`c" if i % 2 else "w") for i in range(40)] + [(50, None, None), (51, "", "w"), (None, "the of", None), (3, "the and of", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    for name in ("n_tokens", "posterior", "_hits", "_text", "_copies", "_copy", "rate"):
        df = df.withColumn(name, F.lit("kept"))
    labelled = df.select("doc_id", "domain")
    found = M.mixed(df, labelled, {"w": 0.5, "a.b`c": 0.5}).collect()
    assert len(found) == len(rows) and {r["n_tokens"] for r in found if r["doc_id"] in (50, 51)} == {0}
    out = M.resampled(df, labelled, {"w": 0.9, "a.b`c": 0.1})
    assert out.columns == df.columns and {r["n_tokens"] for r in out.collect()} == {"kept"}
    assert M.mixed(df.limit(0), labelled).count() == 0 and {r["rate"] for r in M.mixed(df, labelled.limit(0)).collect()} == {1.0}


def test_long_texts_are_read_in_slices(spark, monkeypatch):
    rng = np.random.default_rng(4)
    words = {"a": "the and of to".split(), "b": "der die das und".split()}
    rows = [(i, "".join(f"{w}{rng.choice([' ', chr(10), ', ', '  '])}" for w in rng.choice([*words["ab"[i % 2]], *words["ba"[i % 2]][:1], "x1"], 150)), "ab"[i % 2]) for i in range(40)]
    rows += [(40, "the" * 200 + " the", "a"), (41, " " * 300, "b"), (42, "\u3000und\u0085" * 90, "b"), (43, None, None), (44, "DER " * 100 + "\n", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    whole = M.fit_domains(df, df)
    want = sorted(tuple(r) for r in M.posteriors(df, whole).select("doc_id", "n_tokens", "posterior").collect())
    assert not df.where(M.is_long(F.col("text"))).count()
    monkeypatch.setattr(M, "LONG", 64)  # bytes, in place of a text of a megabyte
    assert df.where(M.is_long(F.col("text"))).count() == 44
    parts = {r["doc_id"]: r["s"] for r in df.where("text is not null").select("doc_id", M.slices(F.col("text")).alias("s")).collect()}
    assert all([w for p in parts[i] for w in p.split()] == t.split() and max(map(len, parts[i])) <= (600 if i in (40, 42) else 64) for i, t, _ in rows if t)
    assert M.fit_domains(df, df) == whole
    assert sorted(tuple(r) for r in M.posteriors(df, whole).select("doc_id", "n_tokens", "posterior").collect()) == want


def test_copies_keep_the_mean(spark):
    df = spark.range(20_000).select(M.copies(F.lit(1.37), F.col("id")).alias("c"))
    assert df.agg(F.avg("c")).first()[0] == pytest.approx(1.37, abs=0.02) and {r[0] for r in df.distinct().collect()} == {1, 2}
