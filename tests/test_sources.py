"""Sources, sinks, streams and the whole pipeline, on small folders."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from leafmill.functions import jsonx as J
from leafmill.functions import prompts as R
from leafmill.operators import evaluate as E
from leafmill.operators import segment as S
from leafmill.plans import pipeline
from leafmill.sources import files, sinks
from leafmill.streaming import ingest

CATALOGUE = "Preface\n1. Dicotyledones.\nROSACEAE\n1. Rosa canina L.\na. one\nb. two\nPoa annua L.\nMonocotyledones\nGRAMINEAE\nAvena sativa\n"
CONFIG = {"divisions": ["Dicotyledones", "Monocotyledones"], "crop": False}


def folder(path, **contents):
    path.mkdir(parents=True, exist_ok=True)
    for name, content in contents.items():
        (path / name.replace("__", ".")).write_bytes(content if isinstance(content, bytes) else content.encode())
    return f"file://{path}"


def test_files_by_suffix(spark, tmp_path):
    root = folder(tmp_path / "scans", a__png="x", b__PNG="y", c__txt="z", Thumbs__db="t")
    (tmp_path / "scans" / "sub").mkdir()
    assert [r["name"] for r in files.load_files(spark, root).collect()] == ["a.png"]
    assert [r["name"] for r in files.load_files(spark, f"{root}/b.PNG").collect()] == ["b.PNG"]


def test_crops_come_first(spark, tmp_path):
    root = folder(tmp_path / "k", a__png="x")
    assert files.data_dir(spark, root, True) == (root, True)
    folder(tmp_path / "k" / "extracted_images", p_1__png="x")
    assert files.data_dir(spark, root, False)[0].endswith("extracted_images")
    folder(tmp_path / "k" / "cropped", a_cropped_1__png="x")
    assert files.data_dir(spark, root, True) == (f"{root}/cropped", False)
    with pytest.raises(FileNotFoundError):
        files.data_dir(spark, folder(tmp_path / "empty"), False)


def test_pdf_pages(spark, tmp_path):
    root = folder(tmp_path / "p", a__pdf="one|two", b__png="x")
    rows = files.pdf_pages(files.load_files(spark, root), lambda data: data.split(b"|")).orderBy("name").collect()
    assert [(r["name"], bytes(r["content"])) for r in rows] == [("a_1.png", b"one"), ("a_2.png", b"two"), ("b.png", b"x")]


def test_text_config_json_csv(spark, tmp_path):
    root = folder(tmp_path / "t", extracted_text__txt="line\nline", c__yaml="divisions: [A]\nsystem:\n  setup: x\n", d__json='{"taxa": [{"scientific_name": null}]}', e__csv=',family_name,species_name,description\n0,F,"a ""b""\nc",d\n1,,x,\n')
    assert files.cached_text(spark, root).first()["text"] == "line\nline" and files.cached_text(spark, f"{root}/none") is None
    assert files.load_config(spark, f"{root}/c.yaml")["system"] == {"setup": "x"} and files.load_config(spark, None) is None
    assert files.read_records(spark, f"{root}/d.json", J.TAXA).first()["taxa"][0]["scientific_name"] is None
    assert files.read_records(spark, {"taxa": []}, J.TAXA).first()["taxa"] == []
    with pytest.raises(ValueError):
        files.read_records(spark, 3, J.TAXA)
    rows = files.read_evaluation(spark, f"{root}/e.csv").orderBy("row_no").collect()
    assert [tuple(r)[1:] for r in rows] == [("F", 'a "b"\nc', "d"), (None, "x", None)]


def test_rows_of_several_files_keep_their_order(spark, tmp_path):
    head = "family_name,species_name,description\n"
    root = folder(tmp_path / "g", a__csv=head + "F,x,a1\nF,x,a2\n", b__csv=head + "F,x,b\n" * 500)
    rows = files.read_evaluation(spark, root)
    assert [r["description"] for r in rows.orderBy("row_no").limit(2).collect()] == ["a1", "a2"]
    assert [r["description"] for r in E.first_descriptions(rows).collect()] == ["a1"]


def test_lines_of_json(spark, tmp_path):
    path = sinks.save_json(spark.range(5).coalesce(1), f"file://{tmp_path}/l")
    assert sorted(r["id"] for r in files.read_records(spark, path, "id long", lines=True).collect()) == [0, 1, 2, 3, 4]


def test_csv_header_and_blanks(spark, tmp_path):
    sinks.save_csv(spark.createDataFrame([(" a ", "x")], "v string, w string"), f"file://{tmp_path}/o", ["v"])
    text = "".join(p.read_text() for p in (tmp_path / "o").glob("part-*") if p.stat().st_size)
    assert text.splitlines()[0] in (",v,w", '"",v,w') and text.splitlines()[1].replace('"', "") == "0, a ,x"


def test_free_names(spark, tmp_path):
    root = folder(tmp_path / "n", a__json="1", a_0__json="1")
    assert sinks.free_name(spark, root, "a") == "a_1" and sinks.free_name(spark, root, "b") == "b"


def test_index_over_ranges(spark, tmp_path):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v"))
    rows = sinks.indexed(df, ["v"]).orderBy("index").collect()
    assert [(r["index"], r["v"]) for r in rows] == [(i, i) for i in range(1000)]
    assert sinks.indexed(df.limit(0), ["v"]).count() == 0
    sinks.save_csv(df, f"file://{tmp_path}/out.csv", ["v"])
    back = spark.read.csv(f"file://{tmp_path}/out.csv", header=True)
    assert back.count() == 1000 and back.where("v = 5").first()[0] == "5"


def test_export_and_images(spark, tmp_path):
    records = spark.createDataFrame([("D", 1, "b"), ("D", 0, "a"), ("E", 0, "c")], "division string, n int, x string").withColumn("record", F.struct("x"))
    assert json.loads(sinks.export_json(records, order=["n"])) == {"D": [{"x": "a"}, {"x": "b"}], "E": [{"x": "c"}]}
    images = spark.createDataFrame([("a.png", bytearray(b"12")), ("b.png", None)], "name string, content binary")
    assert [tuple(r) for r in sinks.save_images(images, f"file://{tmp_path}/img").collect()] == [("a.png", 2)]
    assert (tmp_path / "img" / "a.png").read_bytes() == b"12"
    sinks.save_text(spark.createDataFrame([("x",)], "t string"), f"file://{tmp_path}/txt")
    sinks.save_text(spark.createDataFrame([("y",)], "t string"), f"file://{tmp_path}/txt", "append")
    assert sorted(r[0] for r in spark.read.text(f"file://{tmp_path}/txt").collect()) == ["x", "y"]
    assert sinks.save_json(records, f"file://{tmp_path}/j").endswith("j.json")


def test_pipeline_from_images_and_from_text(spark, tmp_path):
    half = CATALOGUE.index("Poa")
    root = folder(tmp_path / "cat", p_10__png=CATALOGUE[half:], p_9__png=CATALOGUE[:half])
    config = R.Config({**CONFIG, "output_save_path": f"file://{tmp_path}/out", "output_save_file_name": "cat"})
    result = pipeline.run(spark, root, config)
    flat = {(r["division"], r["family_name"], r["species_name"], r["description"]) for r in result.flat.collect()}
    assert ("Dicotyledones", "ROSACEAE", "1. Rosa canina L.", "a. one") in flat and ("Monocotyledones", "GRAMINEAE", "Avena sativa", None) in flat
    assert pipeline.save(result, config) == "cat" and pipeline.save(result, config) == "cat_0"
    assert spark.read.csv(f"file://{tmp_path}/out/cat.csv", header=True).count() == len(result.flat.collect())
    assert pipeline.run(spark, root, config, ocr_only=True).blocks is None
    folder(tmp_path / "cat", extracted_text__txt=CATALOGUE)
    again = pipeline.run(spark, root, config, test=True)
    assert {(r["family_name"], r["species_name"]) for r in again.flat.collect()} == {(f, s) for _, f, s, _ in flat}


def test_empty_text_has_no_blocks(spark):
    df = spark.createDataFrame([("c", ""), ("d", None)], "catalogue string, text string")
    assert pipeline.transcribe(df, R.Config(CONFIG)).flat.count() == 0


def test_command_line():
    own = pipeline.parser().parse_args(["images", "prompt.yaml", "--ocr-only"])
    assert own.ocr_only and not own.test and own.prompt == "prompt.yaml"


def test_pages_as_a_stream(spark, tmp_path):
    source, target = f"file://{tmp_path}/pages", f"file://{tmp_path}/cleaned"
    pages = spark.createDataFrame([(i, 0, f"x-\ny {i}\n\n\n12\n") for i in range(20)], ingest.PAGES)
    pages.repartition(5).write.parquet(source)
    for _ in range(2):  # nothing is done twice
        ingest.run_to_end(ingest.cleaned(ingest.page_stream(spark, source)), f"file://{tmp_path}/state", ingest.to_parquet(target))
    out = spark.read.parquet(target)
    assert out.count() == 20 and out.where("batch > 0").count() > 0
    assert {r["text"] for r in out.collect()} == {f"xy {i}" for i in range(20)}


def test_divisions_carried_over_batches(spark, tmp_path):
    source, target = f"file://{tmp_path}/pages", f"file://{tmp_path}/divided"
    for n, text in enumerate(["Dicotyledones a", "still dicotyledones here", "b Monocotyledones c"]):
        spark.createDataFrame([(1, n, text), (2, n, None)], ingest.PAGES).coalesce(1).write.mode("append").parquet(source)
        ingest.run_to_end(ingest.carried_divisions(ingest.page_stream(spark, source), CONFIG["divisions"]), f"file://{tmp_path}/state", ingest.to_parquet(target))
    rows = spark.read.parquet(target).orderBy("page_no", "ord").collect()
    assert [(r["division"], r["part"]) for r in rows] == [("Dicotyledones", " a"), ("Dicotyledones", "still "), ("Dicotyledones", "dicotyledones here"), ("Dicotyledones", "b "), ("Monocotyledones", " c")]


def test_images_and_windows_as_streams(spark, tmp_path):
    root = folder(tmp_path / "scans", a__png="x", b__txt="y")
    ingest.run_to_end(ingest.image_stream(spark, root), f"file://{tmp_path}/s1", ingest.to_parquet(f"file://{tmp_path}/o1"))
    assert [r["name"] for r in spark.read.parquet(f"file://{tmp_path}/o1").collect()] == ["a.png"]
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=m), "click", 1.0) for m in (0, 1, 7, 40)]
    spark.createDataFrame(rows, "ts timestamp, event_type string, value double").write.parquet(f"file://{tmp_path}/events")
    events = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(f"file://{tmp_path}/events")
    ingest.run_to_end(ingest.windowed_counts(events), f"file://{tmp_path}/s2", ingest.to_parquet(f"file://{tmp_path}/o2"))
    counts = sorted((r["start"].minute, r["n"]) for r in spark.read.parquet(f"file://{tmp_path}/o2").collect())
    assert counts[:2] == [(0, 2), (5, 1)]


def test_stream_and_table_agree(spark, tmp_path, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.lit(0).alias("page_no"), "text")
    docs.repartition(4).write.parquet(f"file://{tmp_path}/docs")
    ingest.run_to_end(ingest.cleaned(ingest.page_stream(spark, f"file://{tmp_path}/docs")), f"file://{tmp_path}/state", ingest.to_parquet(f"file://{tmp_path}/out"))
    a = ingest.cleaned(docs).select("doc_id", "text")
    b = spark.read.parquet(f"file://{tmp_path}/out").select("doc_id", "text")
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count() and S.NO_FAMILY
