"""The corpus pipeline's stages, each against what it must do with its own input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from leafmill.llm import mixing, quality, secrets, simhash
from leafmill.llm import queries as Q


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Each stage's rows, after those of the documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, sf), "test")
        out.append(docs)
    return out


def test_stages_are_named_in_order():
    assert [n for n, _ in C.STAGES] == ["quality classifier", "SimHash near-duplicates", "secret scans", "mixing", "packing"] and C.ORACLE_SQL is None


def test_columns_stay_to_the_last(stages):
    assert all(d.columns == stages[0].columns for d in stages[:-1])
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(stages[-1].columns)


def test_quality_stage_takes_out_what_it_scores_low(spark, sf, stages):
    docs = stages[0]
    model = quality.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet"))
    want = {r["doc_id"] for r in quality.score(docs.select("doc_id", "text"), model).where(F.col("score") >= quality.THRESHOLD).collect()}
    assert {r["doc_id"] for r in stages[1].collect()} == want and 0 < len(want) < docs.count()


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in stages[1].collect()}
    kept = {r["doc_id"] for r in stages[2].collect()}
    for i in prints:
        reach, more = {i}, [i]
        while more:
            a = more.pop()
            new = {b for b in prints if b not in reach and (prints[a] ^ prints[b]).bit_count() <= 2}
            reach |= new
            more += new
        assert (i in kept) == (i == min(reach))
    assert len(kept) < len(prints)


def test_secret_stage_changes_only_secrets(spark, stages):
    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    after = {r["doc_id"]: r for r in stages[3].collect()}
    assert set(before) == set(after)
    found = {}
    for r in secrets.findings(stages[2], secrets.fit(spark)).collect():
        found.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for i, text in before.items():
        for start, length in sorted(found.get(i, []), reverse=True):
            text = text[:start] + secrets.PLACEHOLDER + text[start + length :]
        assert after[i]["text"] == text and after[i]["n_chars"] == len(text)


def test_mixing_stage_repeats_documents_as_rated(spark, sf, stages):
    known = Q.domains(spark, sf).join(stages[3].select("doc_id"), "doc_id", "left_semi")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed(stages[3], known).collect()}
    found: dict = {}
    for r in stages[4].collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + 1
    assert found == {i: n for i, n in copies.items() if n}


def test_packing_stage_holds_every_id(stages):
    library = Tokenizer.from_file(Q.vocabulary("word_bpe_49k.json"))
    want: dict = {}
    for r in stages[4].collect():
        ids = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + len(ids) // 4
    found: dict = {}
    filled: dict = {}
    for r in stages[5].collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(bytes(r["ids"])) >= 0
    assert found == want and sum(n < 2048 for n in filled.values()) <= 1 and max(filled.values()) <= 2048


def test_odd_tables(spark, sf, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "A plain sentence stands here. It ends.", None, "s", None), (3, "word " * 40_000, "en", "s", 1), (3, "word " * 40_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("_score", "_copies", "_n", "score", "posterior"):
        docs = docs.withColumn(name, F.lit("kept"))
    out = docs
    for name, stage in C.STAGES:
        out = C.written(stage(spark, out, sf), "odd")
        if name != "packing":
            assert out.columns == docs.columns and {r["_score"] for r in out.collect()} <= {"kept"}
    for name, stage in C.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0
