"""The pipeline's near copies, against the Jaccard similarity of all pairs."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as C
from leafmill.llm import similar


def plain_shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stage_against_all_pairs(spark, sf):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(40):
        base = rng.choices(words, k=rng.randint(60, 300))
        for _ in range(rng.randint(1, 5)):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append(" ".join(own))
    rows += ["", None, " \n", "a b", "a b", "a b c"]
    rows += [" ".join(base[:-k]) + " end" for k in range(1, 60)]  # a chain
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    sets = dict(zip(ids, map(plain_shingles, rows)))
    near = {i: [j for j in ids if (len(sets[i] & sets[j]) / len(sets[i] | sets[j]) if sets[i] | sets[j] else 1) >= 0.8] for i in ids}
    want = set()
    for i in ids:
        reach, more = {i}, [i]
        while more:
            new = set(near[more.pop()]) - reach
            reach |= new
            more += new
        want |= {i} if i == min(reach) else set()
    df = spark.createDataFrame(list(zip(ids, rows)), "doc_id long, text string").withColumn("node", F.lit("kept"))
    kept = C.near_duplicate_stage(spark, df, sf)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == want
    assert C.near_duplicate_stage(spark, df.limit(0), sf).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d", "x"), (2, "a b c d", "y"), (1, "another text of an id that repeats", "z"), (1, "a b c d", "x"), (None, "first without an id", "n"), (9, None, "e"), (8, "", "e")]
    kept = similar.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, "first without an id"), (1, "a b c d"), (1, "another text of an id that repeats"), (8, "")]


def test_tiles_of_what_leaders_leave(spark, monkeypatch):
    monkeypatch.setattr(similar, "TILE", 8)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    base = rng.choices(words, k=120)
    texts = []
    for k in range(70):  # pairs of near copies, most of which are far from the others, though in their buckets
        own = list(base)
        for _ in range(rng.randint(1, 9)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts += [" ".join(own), " ".join([*own, f"end{k}"])]
    signs = similar.signed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", [])
    rows = {r["node"]: frozenset(plain_shingles(texts[r["doc_id"]])) for r in signs.collect()}
    left = signs.select(F.explode("keys").alias("key"), "node", F.col("node").alias("own"))
    links = [(r["src"], r["dst"]) for r in similar.rest_links(left, signs.select("node", "keys", "shingles"), 0.8).collect()]
    alike = lambda a, b: len(rows[a] & rows[b]) >= 0.8 * len(rows[a] | rows[b])
    near = [(a, b) for a in rows for b in rows if a < b and alike(a, b)]
    assert links and all(alike(a, b) for a, b in links)

    def parts(pairs):
        of = {n: n for n in rows}
        for a, b in pairs * len(rows):
            of[a] = of[b] = min(of[a], of[b])
            if all(of[x] == of[y] for x, y in pairs):
                break
        return of

    found, want = parts(links), parts(near)
    assert sum(found[n] == want[n] for n in rows) >= len(rows) - 2  # a pair at the very limit shares no key with probability 0.002


def test_simhash_tables_meet_pairs_at_the_limit():
    rng = np.random.default_rng(5)
    for n in (4, 5, 9, 18, 36, 180):
        met = 0
        for _ in range(200):
            own = rng.choice(1 << 32, n + max(1, n // 9), replace=False).astype(np.uint32)
            less = max(1, n // 9)
            a, b = (own[:n], own) if n < 9 else (own[:-less], own[less:])
            (p, x), (q, y) = similar.segment_keys(np.sort(a)), similar.segment_keys(np.sort(b))
            assert similar.jaccard(np.sort(a), np.sort(b)) >= 0.8 and len(set(x.tolist())) == len(x) >= similar.SEGMENTS
            met += bool(set(x.tolist()) & set(y.tolist())) and ((p ^ q) & (1 << 64) - 1).bit_count() <= similar.RADIUS
        assert met >= 196
    votes = similar.votes(np.arange(600, dtype=np.uint32))
    assert (np.abs(votes - 300) < 80).all() and votes.std() > 6  # majorities of even bits
    assert (votes == sum(similar.votes(np.array([i], np.uint32)) for i in range(600))).all()
    p, x = similar.segment_keys(np.arange(600, dtype=np.uint32))
    assert p & (1 << 64) - 1 == sum(1 << 63 - i for i in range(64) if votes[i] > 300)
    own = sum(1 << i for i in range(similar.WIDTH) if votes[i] > 300)
    near = [k for k in x.tolist() if k >> similar.WIDTH == 0]
    assert own in near and len(near) == 1 << similar.FLIPS and max((own ^ k).bit_count() for k in near) == similar.FLIPS


def test_crowded_buckets_link_as_others_do(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(20)]
    base = rng.choices(words, k=200)
    for _ in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    signs = similar.signed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", []).select("node", "print", "keys", "shingles")
    signs = C.written(signs, "test")
    found = [{r["node"]: r["component"] for r in similar.components(signs, hot=hot).collect()} for hot in (1000, 8)]
    assert found[0] == found[1] and len(found[0]) > 40


def edited(rng, n, words, base, most):
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, most)):
            own[rng.randrange(len(own))] = rng.choice(words)
        out.append(" ".join(own))
    return out


def parts_of(rows):
    out: dict = {}
    for r in rows:
        out.setdefault(r["component"], set()).add(r["node"])
    return sorted(map(sorted, out.values()))


def test_rows_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    rng, made = random.Random(8), {}
    words = [f"w{i}" for i in range(3000)]
    texts = edited(rng, 300, words, rng.choices(words, k=250), 24)
    signs = similar.signed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", []).select("node", "print", "keys", "shingles")
    signs = C.written(signs, "test")

    def counted(df, what, *more, **named):
        out = C.written(df, what, *more, **named)
        made[what] = max(made.get(what, 0), out.count())
        return out

    monkeypatch.setattr(similar, "written", counted)
    assert similar.components(signs).count() > 40
    assert max(made.values()) <= 10 * len(texts), made


def test_tables_dealt_by_leading_bits_and_small_tiles(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(rng.choices(words, k=rng.choice((3, 9, 60)))) for _ in range(80)]
    texts += edited(rng, 90, words, rng.choices(words, k=120), 9)
    texts += [t + " end" for t in texts[:40]] + texts[:30]
    signs = similar.signed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), "doc_id", "text", []).select("node", "print", "keys", "shingles")
    signs = C.written(signs, "test")
    want = parts_of(similar.components(signs).collect())
    monkeypatch.setattr(similar, "ENTRIES", 16)
    assert parts_of(similar.components(signs).collect()) == want and len(want) > 10
    monkeypatch.setattr(similar, "TILE", 8)
    assert parts_of(similar.components(signs).collect()) == want


def test_rows_that_are_alone_need_no_place_of_their_own(spark, monkeypatch):
    rows = [(i, f"text {i} of its own" if i % 3 else "the same text again") for i in range(40)] + [(7, "text 7 of its own")] * 2 + [(None, "text 8 of its own")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted([(i, t) for i, t in rows[:40] if i % 3] + [(0, "the same text again")])
    for longs in (1 << 16, 1):
        monkeypatch.setattr(similar, "BITMAP", longs)
        assert sorted(map(tuple, similar.deduplicate(df).collect())) == want


def test_buckets_against_all_pairs():
    rng = np.random.default_rng(9)
    nodes = np.zeros(120, similar._NODE)
    nodes["print"] = rng.integers(0, 1 << 63, (120, similar.WORDS), dtype=np.uint64)
    for i in range(40, 120):  # some near others, some at the very limit, or a bit beyond
        flips = rng.choice(63 * similar.WORDS, similar.WORDS * similar.RADIUS + int(rng.integers(-9, 2)), replace=False)
        nodes["print"][i] = nodes["print"][i % 40]
        for f in flips:
            nodes["print"][i, f // 63] ^= np.uint64(1) << np.uint64(f % 63)
    own, keys = np.repeat(np.arange(120), 6), rng.integers(-60, 60, 720)
    held = [set(keys[own == i].tolist()) for i in range(120)]
    low = list(range(120))
    for a in range(120):
        for b in range(a):
            if held[a] & held[b] and np.bitwise_count(nodes["print"][a] ^ nodes["print"][b]).sum() <= similar.WORDS * similar.RADIUS:
                low = [min(low[a], low[b]) if x in (low[a], low[b]) else x for x in low]
    found = similar.near_in_buckets(nodes, own, keys, 1000)
    assert found.tolist() == low and len(set(low)) < 115
    united = similar.near_in_buckets(nodes, own, keys, 1)
    assert all(united[i] == united[low[i]] for i in range(120)) and len(set(united.tolist())) < len(set(low))


def test_shared_shingles_of_tiles():
    rng = np.random.default_rng(6)
    for n, k in ((0, 5), (2, 3), (30, 40)):
        a, b = ([np.unique(rng.integers(0, 9000, rng.integers(0, 6000), dtype=np.uint32)) for _ in range(m)] for m in (n, k))
        assert similar.in_both(a, b).tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in b] for x in a]
