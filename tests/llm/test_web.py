"""URL filters and WARC archives."""

from __future__ import annotations

import pytest
from comparing import difference
from pyspark.sql import functions as F

from leafmill.llm import queries as Q
from leafmill.llm import url_filters as U
from leafmill.llm import warc as W

# --- url filters --------------------------------------------------------------------------------------------------------------------------------


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]


def plain_rule(host, path):
    best = None
    for text, verdict in (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")):
        own, _, rest = text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and (best is None or len(text) > len(best[0])):
            best = (text, verdict)
    return best


URLS = [
    "http://example.com/en/7", "http://EXAMPLE.com/en/8", "https://a.b.Example.COM/en/71/x?y#z", "http://notexample.com/en/7", "http://x.net/de/", "http://example.net/de/80", "http://net/de/1", "http://aexample.net/de/8",
    "http://m.org/es/", "http://m.org/es", "http://m.org?/es/", "http://m.org#/es/", "//m.org/es/", "", None, "://", "http://", "x://y://z/en/", "http://com/en/", "http://a.com/en/#q", "http://É.COM/en/é", "http://a.com/\n/en", "ftp://u:p@example.com:80/en/7",
]


def test_rules_and_parts(spark):
    df = spark.createDataFrame(list(enumerate([*URLS, URLS[0]])), "page_id long, url string")
    for name in ("host", "path", "shape", "bad", "_key"):
        df = df.withColumn(name, F.lit("x"))
    labels = spark.createDataFrame([(0, None), (1, 1), (1, 0)], "page_id long, bad int")
    found = {r["page_id"]: r for r in U.judge(df, labels).collect()}
    assert len(found) == len(URLS) + 1
    for i, url in enumerate([*URLS, URLS[0]]):
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        r = found[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0]), url
        assert r["verdict"] == (rule[1] if rule else r["verdict"]) and r["verdict"] in ("allow", "block")


def test_bad_templates_are_blocked(spark):
    rows, labels = [], []
    for i in range(400):
        kind = ("tag", "news", "shop", "about")[i % 4]
        path = f"/{kind}/word{i}x/{i}.html" if kind != "about" else "/about"
        rows.append((i, f"http://site{i % 3}.test{path}?a={i}"))
        if i % 5 == 0:
            labels.append((i, int(kind == "tag" or (kind == "shop" and i % 40 == 0))))
    df, known = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int")
    found = U.judge(df, known).collect()
    assert {r["path"].split("/")[1] for r in found if r["verdict"] == "block"} == {"tag"}
    assert all(r["verdict"] == "block" for r in found if r["path"].startswith("/tag/"))
    assert len({r["template"] for r in found}) <= 12  # variable segments are wildcards


def test_rare_sections_with_labels_of_their_own_are_blocked(spark):
    names = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november".split()
    rows, labels = [], []
    for k, name in enumerate([*names, "casino"]):
        for i in range(100 if name == "casino" else 400):
            rows.append((len(rows), f"http://big.test/{name}/{i}"))
            if i % 4 == 0:
                labels.append((len(rows) - 1, int(name == "casino")))
    df, known = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int")
    blocked = {r["path"].split("/")[1] for r in U.judge(df, known).collect() if r["verdict"] == "block"}
    assert blocked == {"casino"}  # 1.8% of the host's urls


def test_deep_sections_and_sections_with_digits(spark):
    bad = ("/a/b/c/d/e/f/spam/", "/x/casino777/", "/api/v2/")
    good = ("/a/b/c/d/e/f/news/", "/x/news24/", "/api/v1/")
    rows = [(k * 300 + i, f"http://deep.test{part}{i}/") for k, part in enumerate(bad + good) for i in range(300)]
    rows.append((9999, "http://deep.test/" + "trap/" * 300))
    labels = [(i, int(i < 900)) for i, _ in rows[:-1] if i % 4 == 0]
    df, known = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int")
    found = {r["page_id"]: r["verdict"] for r in U.judge(df, known).collect()}
    assert len(found) == len(rows) and all((found[i] == "block") == (i < 900) for i, _ in rows[:-1])


def test_few_labels_do_not_reject(spark):
    df = spark.createDataFrame([(i, f"http://s.test/a/{i}") for i in range(50)], "page_id long, url string")
    one = spark.createDataFrame([(0, 1)], "page_id long, bad int")
    assert {r["verdict"] for r in U.judge(df, one).collect()} == {"allow"}
    assert {r["verdict"] for r in U.judge(df, one.limit(0)).collect()} == {"allow"} and U.judge(df.limit(0), one).count() == 0


def test_op1(spark, sf):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    found = Q.op1_url_filters(spark, sf).collect()
    assert {r["page_id"] for r in found} == set(urls) and len(found) == len(urls)
    for r in found:
        rule = plain_rule(*plain_parts(urls[r["page_id"]]))
        assert (r["host"], r["path"]) == plain_parts(urls[r["page_id"]]) and r["rule"] == (rule and rule[0]) and (not rule or r["verdict"] == rule[1])


# --- WARC ---------------------------------------------------------------------------------------------------------------------------------------

ROWS = [
    (5, "http://a/", "same"), (3, "http://b/", "same"), (9, None, "same"), (3, "http://b/", "same"), (1, "http://c/", None), (2, "http://d/", ""), (None, "http://e/", "alone"), (7, "http://é/", "WARC/1.1\r\n\r\n\r\n0\r\n\r\nContent-Length: 5"),
    (8, "u", "é" * 400_000), (10, "v", "é" * 400_000), (11, "w", "x" * W.CHUNK), (12, "y", "\x00\r\n"), (13, "z", "q" * (W.SEGMENT - 60)),
]


def pages(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    for name in ("id", "sha", "body", "refers_to"):
        df = df.withColumn(name, F.lit("x"))
    return df


def test_round_trip(spark):
    found = sorted((tuple(r) for r in W.round_trip(pages(spark)).collect()), key=str)
    lead: dict = {}
    for i, _, html in ROWS:
        own = (html or "").encode()
        lead[own] = min(lead.get(own, i if i is not None else 10**9), i if i is not None else 10**9)
    want, seen = [], set()
    for i, _, html in ROWS:
        own = (html or "").encode()
        first = (i if i is not None else 10**9) == lead[own] and own not in seen
        seen |= {own} if first else set()
        want.append((i, len(own), W.digest(own), "response" if first else "revisit", None if first else lead[own]))
    assert found == sorted(want, key=str)
    assert W.round_trip(pages(spark).limit(0)).count() == 0


def test_payloads_come_back_whole(spark, tmp_path):
    W.write_archives(pages(spark), f"file://{tmp_path}/w", revisit_from=5)
    rows = W.resolved(W.read_archives(spark, f"file://{tmp_path}/w")).collect()
    assert sorted(bytes(r["payload"]) for r in rows) == sorted((h or "").encode() for *_, h in ROWS)
    assert sum(r["record_type"] == "revisit" for r in rows) == 1  # short payloads are all responses
    assert {r["target"] for r in rows} == {u for _, u, _ in ROWS}


def test_segments_are_verified(spark, tmp_path):
    records = list(W.response_records("urn:1", "t", b"abc" * 200, W.digest(b"abc" * 200), segment=100))
    assert len(records) > 5

    def read(own, name):
        (tmp_path / name).mkdir()
        for k, part in enumerate(own):  # one record to a file, in any order
            (tmp_path / name / f"{k}.warc").write_bytes(part + b"\r\n\r\n")
        return W.read_archives(spark, f"file://{tmp_path}/{name}").collect()

    assert bytes(read(records[::-1], "whole")[0]["payload"]) == b"abc" * 200
    for name, own in (("gap", records[:3] + records[4:]), ("end", records[:-1]), ("twice", [*records, records[2]])):
        with pytest.raises(Exception, match="segments|total length"):
            read(own, name)
    with pytest.raises(Exception, match="digest"):
        read([W.record([("WARC-Type", "response"), ("WARC-Record-ID", "<x>"), ("WARC-Payload-Digest", "sha1:X")], b"HTTP/1.1 200 OK\r\n\r\nbody")], "false")


def test_chunked_framing():
    assert W.dechunked(b"3;x=y\r\nabc\r\n1\r\nd\r\n0\r\nTrailer: t\r\n\r\n") == b"abcd" and W.dechunked(W.chunked(b"")) == b""
    for broken in (b"", b"3\r\nab", b"zz\r\n", b"3\r\nabcd\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            W.dechunked(broken)
    with pytest.raises(ValueError):
        list(W.records_of(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort"))


def test_most_long_pages_are_segmented(spark, sf, tmp_path):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    W.write_archives(df, f"file://{tmp_path}/w")
    heads = [h for f in (tmp_path / "w").glob("*.gz") for h, _ in W.records_of(W.plain(f.read_bytes()))]
    kinds = [h["warc-type"] for h in heads]
    firsts = sum(h.get("warc-segment-number") == "1" for h in heads)
    long = df.where("octet_length(html) > 4096").select("html").distinct().count()
    assert firsts >= long > 0 and kinds.count("continuation") >= firsts
    assert max(len(b) for f in (tmp_path / "w").glob("*.gz") for _, b in W.records_of(W.plain(f.read_bytes()))) <= W.SEGMENT


def test_op4_against_sql(spark, sf):
    assert difference(spark, Q.op4_warc, Q.OP4, sf) == ""


def test_headers_of_odd_urls_and_ids(spark):
    rows = [("a:b", "http://a/\r\n\r\nx", "one"), ("-", "http://a/\nWARC-Type: revisit", "two"), (None, None, "three"), ("é %3A +", "http://b/\x00", "two"), ("-5", "x", "one")]
    df = spark.createDataFrame(rows, "page_id string, url string, html string").withColumn("sha", F.lit("kept"))
    found = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in W.round_trip(df).collect()}
    assert found == {"a:b": ("revisit", "-5", 3), "-5": ("response", None, 3), "-": ("response", None, 3), None: ("response", None, 5), "é %3A +": ("revisit", "-", 3)}
