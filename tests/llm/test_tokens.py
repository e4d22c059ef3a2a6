"""Token counts and packing against the tokenizers' own library."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leafmill.llm import packing as P
from leafmill.llm import queries as Q
from leafmill.llm import token_counts as C

BYTES, WORDS = Q.vocabulary("byte_bpe_50k.json"), Q.vocabulary("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "\n\n  \n", "Hello world", "it's they'LL I'm 'tis", "<|endoftext|>", "a <|endoftext|> b", "<|endoftext", "<|startoftext|>x", "Straße ẞ ǅ İ ı ﬁ", "日本語 テスト", "😀👍🏽 é ‍", "x" * 3000,
    " lead", "trail ", "a b c　d", "\x00\x01\x1c\x1f\x85", "1234567890 ³ ½ ٣", "don't--stop... ok?!", "AbC" * 40, "tab\tsep\r\nend", "﻿bom", "naïve café ŒUVRE", "word " * 5000, "''s 's's", "a\x1cb", "ÀÉÎ×÷ÿ",
]
SHARED = st.text(alphabet=st.one_of(st.sampled_from("aeiouthnrs AEIOU'\n.,0159é-ßÿ<|>"), st.characters(codec="utf-8")), max_size=60)


@pytest.fixture(scope="module")
def libraries():
    return {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}


@pytest.mark.parametrize("text", TEXTS)
def test_counts_and_ids_of_cases(libraries, text):
    assert C.TokenCounter.of(BYTES).count(text) == len(libraries[BYTES].encode(text or "", add_special_tokens=False).ids)
    assert np.frombuffer(P.WordTokenizer.of(WORDS).encode(text), "<u4").tolist() == libraries[WORDS].encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(SHARED)
def test_counts_and_ids_of_any_text(text):
    a, b = Tokenizer.from_file(BYTES) if not _LIB else _LIB[0], _LIB[1] if _LIB else Tokenizer.from_file(WORDS)
    _LIB[:] = [a, b]
    assert C.TokenCounter.of(BYTES).count(text) == len(a.encode(text, add_special_tokens=False).ids)
    assert np.frombuffer(P.WordTokenizer.of(WORDS).encode(text), "<u4").tolist() == b.encode(text, add_special_tokens=False).ids


_LIB: list = []


def test_proved_strings_are_single_tokens(libraries):
    whole = sorted(C.TokenCounter.of(BYTES).whole)
    assert len(whole) > 40_000
    assert all(len(e.ids) == 1 for e in libraries[BYTES].encode_batch(whole, add_special_tokens=False))


def test_memory_of_units_is_bounded(monkeypatch):
    monkeypatch.setattr(C, "REMEMBERED", 10)
    own = C.TokenCounter(BYTES)
    own.count(" ".join(f"unit{i}" for i in range(40)))
    own.count("again and again")
    assert len(own.seen) <= 50


def test_op8(spark, sf, libraries):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    found = Q.op8_token_counts(spark, sf).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(libraries[BYTES].encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)


def test_counts_of_odd_tables(spark):
    df = spark.createDataFrame([(1, None), (1, "a b"), (1, "a b"), (None, "x")], "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in C.count_tokens(df, BYTES).collect()) == [(0, 1, 1), (1, 0, 0), (1, 3, 2), (1, 3, 2)]
    assert C.count_tokens(df.limit(0), BYTES).count() == 0


# --- packing ------------------------------------------------------------------------------------------------------------------------------------


def holds(pieces, tokens, window):
    """Checks the contract: each id in one piece, sequences gapless from 0, all but one full."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(tokens)
    for doc_id, own in by_doc.items():
        own.sort(key=lambda p: p["start"])
        at = 0
        for p in own:
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(tokens[doc_id])
            assert p["ids_crc32"] == zlib.crc32(np.array(tokens[doc_id][at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(tokens[doc_id])
    loose = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        at = 0
        for p in own:
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        loose += at < window
    assert loose <= 1
    assert sorted(by_sequence) == list(range(len(by_sequence)))


@pytest.mark.parametrize("window, seed, shape", [(16, 1, 40), (32, 2, 200), (8, 3, 7), (2, 4, 5), (64, 5, 64)])
def test_packing_of_random_lengths(spark, window, seed, shape):
    rng = np.random.default_rng(seed)
    tokens = {i: rng.integers(0, 50_000, int(rng.integers(1, shape + 1))).tolist() for i in range(300)}
    df = spark.createDataFrame([(i, len(t), bytearray(np.array(t, "<u4").tobytes())) for i, t in tokens.items()], "doc_id long, doc_tokens long, ids binary")
    pieces = P.pack(df, window, buckets=4).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset").collect()
    holds([p.asDict() for p in pieces], tokens, window)


def plain_fill(counts, capacity):
    best = {0: {}}
    for k, n in counts.items():
        for total, pick in list(best.items()):
            for m in range(1, n + 1):
                if total + k * m <= capacity:
                    best.setdefault(total + k * m, pick | {k: m})
    return max(best)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), min_size=1, max_size=5), st.integers(1, 30))
def test_best_fill_is_the_closest(counts, capacity):
    pick = P.best_fill(counts, capacity)
    assert all(n <= counts[k] for k, n in pick.items()) and sum(k * n for k, n in pick.items()) == plain_fill(counts, capacity)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 15), st.integers(1, 1000), max_size=8))
def test_plan_uses_every_piece_once(histogram):
    runs, windows = P.plan(histogram, 16)
    total = sum(k * n for k, n in histogram.items())
    assert windows == -(-total // 16)
    assert sum(cut * per * times for _, _, per, times, _, _, cut, _ in runs) == total


def test_plan_does_not_grow_with_counts():
    rng = np.random.default_rng(1)
    base = {int(k): int(n) for k, n in zip(range(1, 2048), rng.integers(1, 50, 2047))}
    small, large = P.plan(base, 2048)[0], P.plan({k: n * 1_000_000 for k, n in base.items()}, 2048)[0]
    assert len(large) < 20 * len(small) and len(large) < 200_000


def test_op2(spark, sf, libraries):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tokens = {i: libraries[WORDS].encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    holds([r.asDict() for r in Q.op2_packing(spark, sf).collect()], tokens, 2048)


def test_packing_of_odd_tables(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b c " * 3000), (None, "x"), (3, "a b c " * 3000)], "doc_id long, text string")
    for name in ("ids", "_rest", "start", "sequence_id"):
        df = df.withColumn(name, F.lit("x"))
    pieces = P.pack_documents(df, WORDS).collect()
    assert sum(p["length"] for p in pieces if p["doc_id"] == 3) == 2 * 9001 and {p["length"] for p in pieces if p["doc_id"] in (1, 2)} == {1}
    assert P.pack_documents(df.limit(0), WORDS).count() == 0
