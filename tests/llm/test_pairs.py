"""SimHash and embedding near-duplicates, and connected components, against all pairs."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
import xxhash
from comparing import difference
from pyspark.sql import functions as F

from leafmill.llm import embedding_dedup as E
from leafmill.llm import queries as Q
from leafmill.llm import simhash as S
from leafmill.llm._shared import connected_components


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (2000, 2001), (2001, 2000)]
    links += [(rng.randint(3000, 3400), rng.randint(3000, 3400)) for _ in range(300)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    want = roots({n for p in links for n in p}, links)
    assert found == {n: c for n, c in want.items() if any(n in p and p[0] != p[1] for p in links)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# --- SimHash ------------------------------------------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    """The contract, word for word."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, now = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = ["One two three four", "one\ttwo\nthree  FOUR", "", None, "  \r\n ", "a", "a b", "É é ẞ x", "a\x1cb c d", "a\xa0b c d e", "x y z " * 2000, "word" * 5000, "ab " * 3, "😀 b c d"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("most", [0, 1, 2])
def test_links_within_the_distance(spark, most):
    rng = random.Random(most)
    values = []
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            values.append(base)
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
    values += [0, 1, 1 << 63, (1 << 64) - 1]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, simhash long")
    found = {r["simhash"]: r["component_id"] for r in S.components(df, max_distance=most).collect()}
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= most]
    want = roots(range(len(values)), pairs)
    assert [found[v] for v in signed] == [want[i] for i in range(len(values))]


@pytest.mark.parametrize("most, segments, hot", [(2, 2, 64), (2, 2, 3), (2, 3, 1), (2, 4, 5), (1, 1, 2), (1, 2, 1), (2, 2, 0)])
def test_links_by_any_segments_and_bucket_bounds(spark, most, segments, hot):
    rng = random.Random(10 * segments + hot)
    base = rng.getrandbits(64)
    prints = {base ^ (rng.getrandbits(32) & rng.getrandbits(32) & rng.getrandbits(32)) << rng.choice((0, 32)) for _ in range(150)}  # segments that many share
    prints |= {x ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for x in list(prints)[:80]} | {rng.getrandbits(64) for _ in range(30)} | {0, 1 << 63, (1 << 64) - 1}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "simhash long")
    found = [(r["src"], r["dst"]) for r in S.ball_edges(df, max_distance=most, segments=segments, hot=hot).collect()]
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= most]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= most for a, b in found)
    assert roots(signed, found) == roots(signed, near) and near


def test_simhash_rows(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, TEXTS[0]), (50, TEXTS[0]), (None, "alone here now"), (7, "other text of an id that repeats")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = S.near_duplicates(df).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append((r["simhash"] & (2**64 - 1), r["component_id"]))
    assert by[1][0] == by[50][0] == by[50][1] == (plain_fingerprint(TEXTS[0]), 0) and by[2][0] == by[3][0] == by[4][0] == (0, 2)
    assert by[None] == [(plain_fingerprint("alone here now"), None)]
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d", "x"), (2, "a b c d", "y"), (1, "another text of an id that repeats", "z"), (1, "a b c d", "x"), (None, "first without an id", "n"), (None, "second one, also without", "n"), (9, None, "e"), (8, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("_n", "simhash", "component_id", "_keep", "_a", "_b"):  # extra columns with the operator's own names
        df = df.withColumn(name, F.lit(name))
    kept = S.deduplicate(df)
    assert kept.columns == df.columns and {r["_n"] for r in kept.collect()} == {"_n"}
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.select("doc_id", "text").collect()) == [(-1, "first without an id"), (-1, "second one, also without"), (1, "a b c d"), (1, "another text of an id that repeats"), (8, "")]
    assert S.deduplicate(df.limit(0)).count() == 0


def test_op5_over_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs}
    ids = sorted(prints)
    want = roots(ids, [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= 2])
    found = Q.op5_simhash(spark, sf).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {i: (f"{prints[i]:016x}", want[i]) for i in ids}
    assert any(want[i] != i for i in ids)


# --- embeddings ---------------------------------------------------------------------------------------------------------------------------------


def plain_links(rows, threshold=0.93):
    unit, out = {}, []
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(np.array(v, np.float32), np.float64)
            unit[i] = x / np.abs(x).max()
    for i in unit:
        for j in unit:
            if j < i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                a, b = unit[i], unit[j]
                if float(a @ b) / np.sqrt(float(a @ a) * float(b @ b)) >= threshold:
                    out.append((j, i))
    return out


def vectors(seed=1, groups=12, dims=24):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        center = rng.standard_normal(dims)
        for _ in range(int(rng.integers(1, 14))):
            rows.append((center + rng.standard_normal(dims) * rng.choice([0.0, 0.1, 0.28, 0.36])).astype(np.float32).tolist())
    return [(i, v, int(rng.integers(0, 2))) for i, v in enumerate(rows)]


ODD = [(900, None, 0), (901, [0.0] * 24, 0), (902, [float("nan")] + [1.0] * 23, 0), (903, [float("inf")] + [1.0] * 23, 0), (904, [None] + [1.0] * 23, 0), (905, [1.0] * 24, None), (906, [1.0] * 24, 0), (907, [1.0] * 23, 0), (908, [], 0), (909, [-0.0, 1.0], 1), (910, [0.0, 2.0], 1), (911, [1e-30, 3e38], 1), (912, [0.0, 1.0], 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_embedding_links_and_components(spark, seed):
    rows = vectors(seed) + ODD
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in ("vec", "node", "ok", "component", "copies"):
        df = df.withColumn(name, F.lit("x"))
    found = {r["vec_id"]: r for r in E.near_duplicates(df).collect()}
    links = plain_links(rows)
    n = dict.fromkeys(range(len(rows)), 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    want = roots(range(len(rows)), links)
    assert len(links) > 50
    for i, (vec_id, *_) in enumerate(rows):
        r = found[vec_id]
        assert (r["n_links"], r["component_id"], r["kept"]) == (n[i], rows[want[i]][0], want[i] == i), vec_id
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_embedding_hot_group_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE", 64)
    rng = np.random.default_rng(5)
    center = rng.standard_normal(16)
    near = [(center + rng.standard_normal(16) * 0.12).astype(np.float32).tolist() for _ in range(400)]
    rows = [(i, v, 3) for i, v in enumerate(near + [near[0]] * 200)]
    found = {r["vec_id"]: r["n_links"] for r in E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    n = dict.fromkeys(range(len(rows)), 0)
    for a, b in plain_links(rows):
        n[a] += 1
        n[b] += 1
    assert found == n


def test_repeated_ids_count_as_vectors(spark):
    v = [1.0, 2.0, 3.0]
    df = spark.createDataFrame([(1, v, 0), (1, v, 0), (2, v, 0), (1, [-1.0, 0.0, 0.0], 0)], "vec_id long, embedding array<float>, label int")
    assert sorted((r["vec_id"], r["n_links"]) for r in E.near_duplicates(df).collect()) == [(1, 0), (1, 2), (1, 2), (2, 2)]


def test_recall_does_not_fall_with_size():
    assert E.passes_for(10**10, 0.93) > E.passes_for(10**4, 0.93) >= 6


def test_embedding_recall_in_a_large_concentrated_label(spark):
    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    aside = lambda x: unit((g := rng.standard_normal(x.shape)) - (g * x).sum(axis=1, keepdims=True) * x)
    n, dims = 6000, 64
    mean = np.repeat(unit(rng.standard_normal((1, dims))), n, axis=0)
    base = 0.8 * mean + 0.6 * aside(mean)
    x = np.vstack([base, 0.935 * base + np.sqrt(1 - 0.935**2) * aside(base)]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(2 * n + i, v.tolist(), 1) for i, v in enumerate(unit(rng.standard_normal((2000, dims))))]
    found = {r["vec_id"]: r["n_links"] for r in E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    y = x.astype(float)
    links = (y @ y.T >= 0.93 * np.linalg.norm(y, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :]).sum(axis=1) - 1
    assert all(found[i] <= links[i] for i in range(2 * n)) and sum(found[i] for i in range(2 * n)) >= 0.9 * links.sum()


def test_op3_against_sql(spark, sf):
    assert difference(spark, Q.op3_embedding_dedup, Q.OP3, sf) == ""


def test_op3_finds_nearly_all_links(spark):
    path = "/root/testdata/sf0.1"
    con = duckdb.connect()
    rows = con.execute(f"select vec_id, embedding, label from '{path}/embeddings.parquet' order by vec_id").fetchall()
    links = plain_links_of_arrays(rows)
    want = dict.fromkeys((r[0] for r in rows), 0)
    for a, b in links:
        want[a] += 1
        want[b] += 1
    found = {r["vec_id"]: r["n_links"] for r in Q.op3_embedding_dedup(spark, path).collect()}
    assert all(found[i] <= want[i] for i in want) and sum(found.values()) >= 0.97 * sum(want.values())


def plain_links_of_arrays(rows):
    out = []
    for label in {r[2] for r in rows if r[2] is not None}:
        own = [(i, v) for i, v, k in rows if k == label and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
        x = np.array([v for _, v in own], np.float64)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        a, b = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
        out += [(own[i][0], own[j][0]) for i, j in zip(a, b)]
    return out
