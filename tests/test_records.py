"""JSON records, prompts, backends, evaluation, layout, images."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.functions import geometry as G
from leafmill.functions import jsonx as J
from leafmill.functions import prompts as R
from leafmill.operators import backends as B
from leafmill.operators import evaluate as E
from leafmill.operators import images as I
from leafmill.operators import layout as L

GOOD = {"family_name": "ROSACEAE", "species": [{"species_name": "Rosa", "number_of_folders": "2", "number_of_sheets": 2.0, "folders_and_sheets": [{"description": "a.", "note": "x", "ok": True, "none": None}]}, {"species_name": "Poa", "number_of_folders": 1, "number_of_sheets": 0}]}


def verified(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, json string")
    return J.verify(df, **options).orderBy("i").collect()


def test_verify(spark):
    cut = dict(GOOD, family_name=None)
    worse = json.loads(json.dumps(GOOD).replace('"2"', "2.5"))
    rows = verified(spark, [json.dumps(GOOD), json.dumps(cut), json.dumps(worse), "{", "", None, "[]", '{"family_name": "X"}'])
    assert [r["verified"] for r in rows] == [True, False, False, False, False, False, False, True]
    own = rows[0]["record"]
    assert own["species"][0]["number_of_folders"] == 2 and own["species"][0]["number_of_sheets"] == 2
    assert own["species"][0]["folders_and_sheets"][0]["description"] == "a. note: x ok: True none: None"
    assert own["species"][1]["folders_and_sheets"] == [] and rows[7]["record"]["species"] == []
    assert rows[3]["error"] == "not JSON" and rows[1]["error"].startswith("required")


@pytest.mark.parametrize("value, number", [("2", 2), ("2.0", 2), ("2.5", None), ("true", 1), ("false", 0), ("x", None), ("", None), ("-3", -3), ("99999999999", None), (None, None)])
def test_lax_int(spark, value, number):
    assert spark.range(1).select(J.lax_int(F.lit(value).cast("string"))).first()[0] == number


@pytest.mark.parametrize("broken", ["```json\n%s\n```", "Here you are: %s Thanks.", "%s,"])
def test_repair_of_surroundings(broken):
    assert json.loads(J.repair_text(broken % json.dumps(GOOD))) == GOOD


def test_repair_of_contents():
    assert json.loads(J.repair_text('{"a": [1, 2,], "b": {"c": "d",}')) == {"a": [1, 2], "b": {"c": "d"}}
    assert json.loads(J.repair_text('{"a": "cut off')) == {"a": "cut off"}
    assert json.loads(J.repair_text('{"a": True, "b": None}')) == {"a": True, "b": None}
    assert J.repair_text("no object") == "no object"


def plain_flat(item, record=None):
    """F2, restated for records as they are here."""
    rows = [dict(record or {})]
    for key, value in item.items():
        if isinstance(value, list) and all(not isinstance(v, (dict, list)) for v in value):
            rows = [r | {key: ",".join(map(str, value))} for r in rows]
        elif isinstance(value, list):
            rows = [r | c for r in rows for v in value for c in plain_flat(v)]
        elif isinstance(value, dict):
            rows = [r | c for r in rows for c in plain_flat(value)]
        else:
            rows = [r | {key: value} for r in rows]
    return rows


def test_flatten(spark):
    record = {"family_name": "X", "species": [{"species_name": "a", "number_of_folders": 1, "number_of_sheets": 2, "folders_and_sheets": [{"description": "p"}, {"description": "q"}]}, {"species_name": "b", "number_of_folders": 0, "number_of_sheets": 0, "folders_and_sheets": []}]}
    df = spark.createDataFrame([(1, json.dumps(record)), (2, '{"family_name": "Y", "species": []}')], "k int, json string")
    flat = J.flatten(J.verify(df), ["k"]).orderBy("k", "species_name", "description").collect()
    want = sorted((r | {"k": k} for k, t in ((1, record), (2, {"family_name": "Y", "species": []})) for r in plain_flat(t)), key=lambda r: (r["k"], r.get("species_name") or "", r.get("description") or ""))
    assert [{k: v for k, v in r.asDict().items() if v is not None} for r in flat] == want  # Q12
    safe = J.flatten(J.verify(df), ["k"], mode="safe").collect()
    assert all(r["species"] is None and r["folders_and_sheets"] is None for r in safe)


def test_add_division(spark):
    rows = spark.range(1).select(F.explode(J.add_division(F.create_map(F.lit("D"), F.array(F.lit(1))))).alias("e")).select("e.*").collect()
    assert [(r["division"], r["data"]) for r in rows] == [("D", [1])]


# --- prompts and backends ---------------------------------------------------------------------------------------------------------------------


def test_deep_defaults():
    assert R.update_missing({"a": None, "b": {"c": 1}}, {"a": 2, "b": {"c": 3, "d": 4}, "e": 5}) == {"a": None, "b": {"c": 1, "d": 4}, "e": 5}
    config = R.Config({"divisions": "One"})
    assert config.divisions == ["One"] and config.get("none", 3) == 3 and config["model"] == "rules"
    with pytest.raises(KeyError):
        config["nothing"]
    assert "model: rules" in config.described()


def test_unravelled():
    assert R.unravelled([{"two words": 1}, "x", ["y"]]) == "Two Words: 1\nxy"


def test_messages_of_both_kinds_agree(spark):
    config = R.Config({"system": {"setup": "s", "schema": "default", "rules": {"a": "b"}}, "user": {"text": "T {extracted_text} and {extracted_text}.", "image": "look"}})
    row = spark.createDataFrame([("body",)], "t string").select(R.conversations(config, F.col("t")).alias("c")).first()["c"]
    assert [{"role": m["role"], "content": [p.asDict() for p in m["content"]]} for m in row] == R.conversation(config, "body")
    assert row[-1]["content"][0]["type"] == "image" and row[-1]["content"][1]["text"] == "look\nbody"
    assert "family_name" in row[1]["content"][0]["text"]
    with pytest.raises(ImportError):
        R.message("schema", "unknown")
    assert R.image_prompt()[1]["content"][0]["type"] == "image" and "bad" in R.json_prompt("bad")[0]["content"][0]["text"]
    assert "before" in R.noise_prompt("x", "before")[1]["content"][0]["text"]


def test_transcription_asks_again_and_keeps_failures(spark):
    class Flaky:  # rubbish, unless asked to repair something good; a class of the test's own travels to the workers
        def __call__(self, messages):
            text = messages[-1]["content"][-1]["text"]
            if text.startswith("Repair"):
                return '{"family_name": "MENDED", "species": []}' if "good" in text else "still bad"
            return "rubbish good" if "good" in text else "rubbish"

    B.register("flaky", Flaky)
    blocks = spark.createDataFrame([("D", "F", "good"), ("D", None, "bad"), ("D", "", "good")], "division string, family string, content string")
    rows = B.transcribed(blocks, R.Config({"user": {"text": "{extracted_text}"}, "model": "flaky"}))
    assert [r["record"]["family_name"] for r in B.accepted(rows).collect()] == ["MENDED", "MENDED"]
    failed = B.quarantine(rows).collect()
    assert [(r["content"], r["json"], r["error"]) for r in failed] == [("bad", "still bad", "not JSON")]


def test_rules_natively_and_as_a_model(spark):
    B.unload("rules")
    content = "1. Rosa canina\na. one\n\nPoa annua\n\n\n"
    blocks = spark.createDataFrame([("D", "ROSACEAE", content)], "division string, family string, content string")
    native = B.transcribed(blocks, R.Config({})).first()
    model = B.transcribed(blocks, R.Config({"user": {"text": "{extracted_text}"}})).first()
    assert native["record"] == model["record"] and native["record"]["species"][0]["folders_and_sheets"][0]["description"] == "a. one"
    with pytest.raises(ImportError):
        B.get_model("no such")


def test_recognition(spark):
    images = spark.createDataFrame([(bytearray(b" text \n"),), (None,)], "content binary")
    assert [r["text"] for r in B.recognized(images).collect()] == ["text", None]


def test_cleaning_by_model(spark):
    class Echo:
        def __call__(self, messages):
            return "Cleaned text: " + messages[-1]["content"][-1]["text"].split("Text:\n")[1].upper()

    B.register("echo", Echo)
    assert B.cleaned_by_model(spark.createDataFrame([("ab",)], "text string"), "echo").first()["text"] == "AB"


def test_entities_and_backbone(spark):
    names = spark.createDataFrame([("Rosa canina",), ("Poa annua",), ("Poa annua",)], "name string")
    df = spark.createDataFrame([(1, "Rosa canina and Poa Rosa canina, Poa annua"), (2, "none"), (3, None)], "k int, t string")
    rows = {r["k"]: r["entities"] for r in B.dictionary_entities(names)(df, "t").collect()}
    assert rows == {1: ["Poa annua", "Rosa canina"], 2: [], 3: []}
    backbone = spark.createDataFrame([("ROSA CANINA", "rosaceae", 7)], "name string, family string, taxon int")
    own = spark.createDataFrame([("Rosa canina", "ROSACEAE"), ("Rosa", "ROSACEAE"), ("Poa annua", "X")], "name string, family string")
    assert sorted((r["name"], r["taxon"]) for r in B.backbone_match(own, backbone).collect()) == [("Poa annua", None), ("Rosa canina", 7)]


# --- evaluation -------------------------------------------------------------------------------------------------------------------------------


def table(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_no long, family_name string, species_name string, description string")


def test_set_metrics(spark):
    gold = table(spark, [("f", "a", "x"), ("f", "a", "y"), ("f", None, "z"), ("g", "b", None)])
    found = table(spark, [("f", "a", "q"), ("g", "c", "r")])
    row = E.set_metrics(gold, found, "species_name").first()
    assert (row["tp"], row["fp"], row["fn"]) == (1, 1, 1) and row["f1"] == pytest.approx(0.5)
    empty = E.set_metrics(gold.limit(0), found.limit(0), "species_name").first()
    assert (empty["tp"], empty["precision"], empty["recall"], empty["f1"]) == (0, 0, 0, 0)


def test_first_description_may_be_null(spark):
    gold = table(spark, [("f", "a", None), ("f", "a", "later"), ("f", "b", "one"), ("f", "b", "two")])
    found = table(spark, [("f", "a", "q"), ("f", "b", "r")])
    assert [tuple(r) for r in E.matched_descriptions(gold, found).collect()] == [("f", "b", "one", "r")]


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_error_rates(spark):
    pairs = [("the cat sat", "a cat sat on"), ("été", "ete"), ("", "x"), ("a b", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    c, w = E.cer(df, "a", "b").first(), E.wer(df, "a", "b").first()
    assert c["edits"] == sum(plain_edits(*p) for p in pairs) and w["edits"] == sum(plain_edits(a.split(), b.split()) for a, b in pairs)
    assert w["words"] == 6 and E.rouge_l(df.limit(0), "a", "b").first()["f1"] is None
    assert E.lcs(list("abcbdab"), list("bdcaba")) == 4 and E.rouge_l_scores("the cats sat", "a cat sat")[2] == pytest.approx(2 / 3)


# --- layout and images ------------------------------------------------------------------------------------------------------------------------


def plain_merge(boxes):
    out = []
    for b in sorted(boxes, key=lambda b: b[0]):
        if out and max(0, min(out[-1][2], b[2]) - max(out[-1][0], b[0])) * max(0, min(out[-1][3], b[3]) - max(out[-1][1], b[1])) > 0:
            last = out.pop()
            b = (min(last[0], b[0]), min(last[1], b[1]), max(last[2], b[2]), max(last[3], b[3]))
        out.append(b)
    return out


def test_merge_columns(spark):
    rng = np.random.default_rng(3)
    pages = []
    for _ in range(40):
        x, y = rng.uniform(0, 100, 8).tolist(), rng.uniform(0, 100, 8).tolist()
        pages.append([(a, b, a + w, b + h) for a, b, w, h in zip(x, y, rng.uniform(1, 30, 8).tolist(), rng.uniform(1, 30, 8).tolist())])
    df = spark.createDataFrame([(i, p) for i, p in enumerate([*pages, []])], "i int, b array<struct<x1:double,y1:double,x2:double,y2:double>>")
    found = [[tuple(m) for m in r["m"]] for r in df.select("i", L.merge_columns(F.col("b")).alias("m")).orderBy("i").collect()]
    assert found == [*map(plain_merge, pages), []]


def test_pad_of_nothing_and_iou(spark):
    b = G.box(0.0, 0.0, 10.0, 20.0)
    row = spark.range(1).select(G.pad(b, 0).alias("p"), G.iou(b, G.box(10.0, 0.0, 20.0, 20.0)).alias("touch"), G.iou(b, G.box(9.0, 0.0, 20.0, 20.0)).alias("over"), G.midpoint(b).alias("m")).first()
    assert tuple(row["p"]) == (0, 0, 10, 20) and not row["touch"] and row["over"] and tuple(row["m"]) == (5, 10)


def test_natural_order(spark):
    df = spark.createDataFrame([(n,) for n in ("p10.png", "p9.png", "p1.png", "q1.png")], "n string")
    assert [r[0] for r in df.orderBy(L.natural_key(F.col("n"))).collect()] == ["p1.png", "p9.png", "p10.png", "q1.png"]


def test_clusterers(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 3, 100, 101)] + [(2, 5.0)], "page int, x double")
    rows = L.gap_groups(df, "page", "x", 10).orderBy("page", "x").collect()
    assert [r["label"] for r in rows] == [0, 0, 0, 1, 1, 0]
    noise = L.clustered_groups(df, "page", "x", lambda v, least: [-1] * len(v) if least > 1 else list(range(len(v))))
    assert {r["label"] for r in noise.collect()} == {0}


def test_roi_without_blocks(spark):
    df = spark.createDataFrame([(1, 0, 0, 1, 1, 10000.0), (2, 5, 6, 50, 60, 10000.0)], "page int, x int, y int, w int, h int, area double")
    rows = {r["page"]: tuple(r)[1:] for r in L.region_of_interest(df, "page", "area", 0.01).collect()}
    assert rows == {1: (None,) * 4, 2: (5, 6, 55, 66)}


def page(width=300, height=200, line=None):
    image = np.full((height, width, 3), 255, np.uint8)
    image[20:180, 20:120] = 0
    image[20:180, 180:280] = 0
    if line:
        image[5:195, line : line + 2] = 0
    return image


def test_split_at_line_and_gutter():
    a, b = I.split(page(line=160))
    assert a.shape[1] == 160 and b.shape[1] == 140
    own = page()
    left, right = I.split(own)
    assert 120 <= left.shape[1] <= 180 and np.array_equal(np.concatenate([left, right], axis=1), own)
    assert I.split(page(120, 300))[1] is None
    middle = I.gutter(own)
    assert 120 <= middle <= 180


def test_crop_resize_and_prepare():
    own = page()
    assert I.crop(own, None, 5) is own and I.crop(own, (20, 20, 120, 180), 0).shape == (160, 100, 3)
    assert I.crop(own, (0, 0, 10, 10), 5).shape == (20, 20, 3) and not I.crop(own, (0, 0, 10, 10), 5)[:5].any()
    assert I.resize(own, 0.5) is own and I.resize(own, 0.6).shape == (120, 180, 3)
    assert I.prepare(own[:60, :60]).shape == (60, 60) and np.array_equal(I.swap_channels(I.swap_channels(own)), own)
    lines = np.full((100, 200), 255, np.uint8)
    lines[::20] = 0
    assert I.skew(lines) == 0 and abs(I.skew(I.rotate(lines, 2.0)) + 2) <= 1 or abs(I.skew(I.rotate(lines, 2.0)) - 2) <= 1


def test_images_as_tables(spark):
    rows = [("scan.png", bytearray(I.encode_npy(page())), (20, 20, 280, 180)), ("b.png", bytearray(I.encode_npy(page())), None)]
    df = spark.createDataFrame(rows, "name string, content binary, roi struct<xmin:int,ymin:int,xmax:int,ymax:int>")
    parts = {r["name"]: I.decode_npy(bytes(r["content"])).shape for r in I.cropped(df, I.Cropper(padding=0, double_pages=True)).collect()}
    assert sorted(parts) == ["b_cropped_1.png", "b_cropped_2.png", "scan_cropped_1.png", "scan_cropped_2.png"] and parts["scan_cropped_1.png"][0] == 160
    small = spark.createDataFrame([("s.png", bytearray(I.encode_npy(page()[:50, :50])))], "name string, content binary")
    assert I.decode_npy(bytes(I.prepared(small).first()["content"])).shape == (50, 50)


def test_stems_of_the_published_examples():
    from leafmill.functions.porter import stem

    words = "caresses ponies ties cats feed agreed plastered motoring sing conflated troubled sized hopping falling failing filing happy sky relational conditional valenci digitizer vietnamization feudalism hopefulness sensibiliti formalize electrical goodness revival airliner adjustable replacement dependent adoption homologous bowdlerize probate rate cease controlling roll generalizations oscillators skies dying"
    stems = "caress poni tie cat feed agre plaster motor sing conflat troubl size hop fall fail file happi sky relat condit valenc digit vietnam feudal hope sensibl formal electr good reviv airlin adjust replac depend adopt homolog bowdler probat rate ceas control roll gener oscil sky die"
    assert [stem(w) for w in words.split()] == stems.split()


def plain_reach(values: list[float], samples: int) -> list[float]:
    """Lengths of a least spanning tree over all pairs."""
    n = len(values)
    core = [sorted(abs(a - b) for b in values)[samples - 1] for a in values]
    group = list(range(n))
    out = []
    for length, i, j in sorted((max(core[i], core[j], abs(values[i] - values[j])), i, j) for i in range(n) for j in range(i)):
        if group[i] != group[j]:
            out.append(length)
            group = [group[i] if g == group[j] else g for g in group]
    return out


def test_density_tree_is_the_least_of_all_pairs():
    import random

    random.seed(4)
    for n, samples in ((2, 1), (12, 3), (40, 10), (40, 1)):
        values = sorted(random.choice([random.gauss(0, 1), random.gauss(30, 2), float(random.randrange(9))]) for _ in range(n))
        assert [e[0] for e in L.reach_tree(np.array(values), samples)] == pytest.approx(plain_reach(values, samples))


def test_density_groups():
    left, right = [100.0 + i % 7 / 10 for i in range(20)], [400.0 + i % 5 / 10 for i in range(15)]
    mixed = [v for pair in zip(left, right) for v in pair] + left[15:] + [900.0]
    labels = L.density_labels(mixed, 5)
    assert [0 if v < 200 else -1 if v > 500 else 1 for v in mixed] == labels
    assert L.density_labels([1.0] * 4, 2) == [-1] * 4 and L.density_labels([], 1) == []
    assert L.density_labels([7.0] * 30, 10) == [-1] * 30 or set(L.density_labels([7.0] * 30, 10)) == {0}


def test_pages_of_few_boxes_are_one_group(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 900.0), (2, 4.0)], "page int, x double")
    assert {r["label"] for r in L.clustered_groups(df, "page", "x").collect()} == {0}


def test_chat_inputs_and_generation(spark):
    talk = [("system", [("text", "a b")]), ("user", [("image", None), ("text", "c d")])]
    df = spark.createDataFrame([(1, talk), (2, None)], f"i int, m {R.MESSAGES}").select("i", R.chat_input(F.col("m")).alias("c")).orderBy("i")
    rows = df.collect()
    assert rows[0]["c"]["prompt"] == "<|system|>\na b\n<|user|>\n<|image|>c d\n<|assistant|>\n" and rows[0]["c"]["images"] == 1 and rows[1]["c"] is None
    said = B.generated(df.select("i", "c.prompt"), "echo", max_new_tokens=1).orderBy("i").collect()
    assert [r["answer"] for r in said] == ["d", None]
    with pytest.raises(ImportError):
        B.generated(df.select("i", "c.prompt"), "no such model")
    with pytest.raises(ValueError):
        B.generated(df.select("i", "c.prompt"), "echo", max_new_tokens=0)


def test_joined_lists_multiply_single_floats(spark, tmp_path):
    from leafmill.plans import record_queries

    spark.createDataFrame([(1, [0.009, -0.5]), (2, None)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [tuple(r) for r in record_queries.q_joined_lists(spark, str(tmp_path)).collect()] == [(1, "9,-500")]  # 8.9999996 in double


def test_density_of_pages_grows_trees_together_without_rows_in_python(spark):
    import random

    random.seed(8)
    pages = [[round(random.choice([random.gauss(0, 9), random.gauss(300, 20)]), 6) for _ in range(n)] for n in (1, 9, 10, 40, 40, 41, 40)]
    df = spark.createDataFrame([(p, k, v) for p, values in enumerate(pages) for k, v in enumerate(values)], "page int, k int, x double")
    found = L.clustered_groups(df, "page", "x")
    alone = L.clustered_groups(df, "page", "x", lambda v, least: L.density_labels(v, least))  # page by page
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, alone.collect())) and found.columns == ["page", "k", "x", "label"]
    assert "InPandas" not in found._jdf.queryExecution().executedPlan().toString()
