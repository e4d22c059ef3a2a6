"""URL filters: explicit rules, and a tree of path templates for each host.

Rules name a host, which they hold for with all its subdomains, and a path
prefix; the longest that fits decides. Other urls are judged by templates.
Segments have a form (numbers, hexadecimal runs, long mixed identifiers and file
suffixes are classes). At each node a segment is written by its form, unless its
own labels tell it from all segments of that form there: a fixed section may
hold digits. The walk goes as deep as paths share a node.
Level by level, a node's children that are many and each
rare are generalised into a wildcard, unless their own labels tell them from
the siblings pooled, and siblings that are statistically
alike - their labelled purity does not differ from that of the siblings pooled
- are merged into one branch. A template is rejected when its purity among
labelled urls, smoothed towards the host's and the corpus's, passes a limit.

All in DataFrame operations. Urls are reduced to counts for each (host, path)
by partial aggregation before any shuffle; the levels work on those counts,
and only the verdicts, one for each (host, path), are joined back.

Cases: a null url, and one without ``://``, have an empty host and path and
are judged by no rule; labels that are null count as none; repeated urls count
each time; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import written


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and a path, as ``example.com/en/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2] if "/" in self.text else ""


RULES = (Rule("com/en/", "block"), Rule("example.com/en/7", "allow"), Rule("net/de/", "allow"), Rule("example.net/de/8", "block"), Rule("org/es/", "block"))


def parsed(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host`` (A-Z lower-cased) and ``path``; both empty for a null url or one without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(F.col("_rest"), r"^([^/?#]*)", 1)
    return (
        urls.withColumn("_rest", F.coalesce(rest, F.lit("")))
        .withColumn("host", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        .withColumn("path", F.regexp_extract(F.col("_rest"), r"^[^/?#]*([^?#]*)", 1))
        .drop("_rest")
    )


def rule_of(rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits ``host`` and ``path``, as struct(rule, verdict); of rules of one length that with the longer host, and of those a block."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block")):  # the last that fits stands
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        best = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(best)
    return best


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != "")


def forms(path: Column) -> Column:
    """The segments of a path by their form."""
    s = path
    for pattern, by in (
        (r"(?<=/)[0-9]+(?=(\.[A-Za-z0-9]{1,5})?(/|$))", "{n}"),
        (r"(?<=/)[0-9a-fA-F-]{8,}(?=(\.[A-Za-z0-9]{1,5})?(/|$))", "{h}"),
        (r"(?<=/)[^/{}]*[0-9][^/{}]*(?=/|$)", "{m}"),
        (r"(?<=/)[^/{}]{41,}(?=/|$)", "{s}"),
    ):
        s = F.regexp_replace(s, pattern, by)
    return segments(s)


def told_apart(seen: str, bad: str, p: Column, z: float) -> Column:
    """Whether labels differ from the purity ``p``; half a label less, as among many some differ by chance."""
    return F.coalesce((F.col(seen) > 0) & ((F.abs(F.col(bad) - F.col(seen) * p) - 0.5) / F.sqrt(F.col(seen) * p * (1 - p)) >= z), F.lit(False))


def templates(labelled: DataFrame, fan_out: int = 12, share: float = 0.02, z: float = 2.0) -> DataFrame:
    """(host, shape, template, n, seen, bad): each path's template. ``labelled``: host, shape (a path's segments), bad (0, 1 or null)."""
    leaves = labelled.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("bad").alias("seen"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    # One row per (host, shape) from here on, written for each level. ``done`` is the generalised prefix.
    t = written(leaves.withColumns({"done": F.array().cast("array<string>"), "form": forms(F.concat(F.lit("/"), F.array_join("shape", "/")))}), "shapes")
    columns, over, d = ["host", "shape", "n", "seen", "bad", "done"], None, 0
    while True:
        # A path that is at its end, or alone at its node, has nothing more to be told from.
        alone = t.groupBy("host", "done").agg(F.count("*").alias("paths"))
        t = written(t.join(alone, ["host", "done"]).withColumn("more", (F.size("shape") > d) & (F.col("paths") > 1)).drop("paths"), "shapes")
        ended = t.where("not more").withColumn("done", F.concat("done", F.slice("form", d + 1, F.greatest(F.size("form") - d, F.lit(0))))).select(columns)
        over = ended if over is None else over.unionByName(ended)
        t = t.where("more").drop("more")
        if not t.limit(1).count():
            break
        t = t.withColumns({"raw": F.get(F.col("shape"), F.lit(d)), "cls": F.get(F.col("form"), F.lit(d))})
        classed = t.where("raw <> cls")
        pools = classed.groupBy("host", "done", "cls").agg(F.sum("seen").alias("ps"), F.sum("bad").alias("pb"))
        known = classed.where("seen > 0").groupBy("host", "done", "cls", "raw").agg(F.sum("seen").alias("ks"), F.sum("bad").alias("kb"))
        p = (F.col("pb") + 0.5) / (F.col("ps") + 1)
        fixed = known.join(pools, ["host", "done", "cls"]).where(told_apart("ks", "kb", p, z)).select("host", "done", "raw", F.lit(True).alias("fixed"))
        t = written(t.join(fixed, ["host", "done", "raw"], "left").withColumn("seg", F.when(F.col("fixed"), F.col("raw")).otherwise(F.col("cls"))).select(*columns, "form", "seg"), "shapes")
        kids = t.groupBy("host", "done", "seg").agg(F.sum("n").alias("kn"), F.sum("seen").alias("ks"), F.sum("bad").alias("kb"))
        pool = kids.groupBy("host", "done").agg(F.count("*").alias("fan"), F.sum("kn").alias("pn"), F.sum("ks").alias("ps"), F.sum("kb").alias("pb"))
        both = kids.join(pool, ["host", "done"])
        rare = (F.col("fan") >= fan_out) & (F.col("kn") < F.greatest(F.lit(2.0), share * F.col("pn"))) & ~told_apart("ks", "kb", p, z)
        apart = F.abs(F.col("kb") / F.col("ks") - p) / F.sqrt(p * (1 - p) / F.col("ks"))
        alike = (F.col("fan") > 1) & (F.col("ks") > 0) & (apart < z)
        quiet = (F.col("fan") > 1) & (F.col("ks") == 0)  # nothing tells it from its siblings
        to = both.select("host", "done", "seg", F.when(rare | alike | quiet, F.lit("*")).otherwise(F.col("seg")).alias("to"))
        t = written(t.join(to, ["host", "done", "seg"]).withColumn("done", F.concat("done", F.array("to"))).select(*columns, "form"), "shapes")
        d += 1
    return written(over, "shapes").select("host", "shape", F.concat(F.lit("/"), F.array_join("done", "/")).alias("template"), "n", "seen", "bad")


def rejected(found: DataFrame, limit: float = 0.8, weight: float = 2.0) -> DataFrame:
    """(host, shape, template, purity, rejected): purity is the share of bad among labelled urls, smoothed to the host's and through it to the corpus's."""
    bad, seen = (x or 0 for x in found.agg(F.sum("bad"), F.sum("seen")).first())
    prior = (bad + 0.5) / (seen + 2)  # a quarter, where nothing is known
    hosts = found.groupBy("host").agg(F.sum("seen").alias("hs"), F.sum("bad").alias("hb"))
    hosts = hosts.select("host", ((F.col("hb") + weight * prior) / (F.col("hs") + weight)).alias("host_purity"))
    own = found.groupBy("host", "template").agg(F.sum("seen").alias("ts"), F.sum("bad").alias("tb"))
    judged = own.join(hosts, "host").withColumn("purity", (F.col("tb") + weight * F.col("host_purity")) / (F.col("ts") + weight))
    judged = judged.select("host", "template", "purity", (F.col("purity") >= limit).alias("rejected"))
    return found.select("host", "shape", "template").join(judged, ["host", "template"])


def judge(urls: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, host, path, rule, verdict, template, purity) for every row. ``labels``: (key, bad), of which a key's mean is taken."""
    own = parsed(urls.select(F.col(key).alias("_key"), F.col(url).alias("url"))).withColumn("shape", segments(F.col("path")))
    known = labels.where("bad is not null").groupBy(F.col(key).alias("_key")).agg((F.avg("bad") >= 0.5).cast("int").alias("bad"))
    learnt = own.join(known, "_key", "left").select("host", "shape", "bad")
    verdicts = rejected(templates(learnt))
    out = own.join(verdicts, ["host", "shape"], "left").withColumn("_rule", rule_of(rules))
    return out.select(
        F.col("_key").alias(key), "host", "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template", "purity",
    )
