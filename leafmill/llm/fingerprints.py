"""Document fingerprints by consistent weighted sampling.

A document is its lower-cased words, weighted by how often they occur. Each of
``SAMPLES`` samples draws, for every word, gamma variates r and c and a uniform
beta, all from a hash of (word, sample), and takes the word of the least
ln c - r (floor(ln w / r + beta) - beta + 1) (Ioffe, 2010). The sampled word
and its floor t are a signature value; two documents share one with a
probability equal to their generalised Jaccard similarity. A fingerprint is
the signature's values, of 16 bits each, in hexadecimal.

With uniforms v and u, r (1 - beta) = -ln v and r beta = -ln u are independent,
as a gamma variate cut at a uniform share is. The least value is then that of
c v (v u)^t, and t is 0 as long as w v < 1: one logarithm for most words.

All in DataFrame operations. A row's two texts are cut into words next to each
other, so that a word which both hold as often is sampled once for both. What
else is known of a row travels among its words as numbered pieces, so texts
are shuffled once, by ranges of doc_id, and nothing after that is.

Cases: a null text is empty; a text without words has a fingerprint of zeros;
equal texts have equal fingerprints; repeated rows are kept, ordered next to
each other; a null doc_id is the last in descending order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import local_rows, written

SAMPLES = 64
MAX_BUCKETS = 16_384
ROWS = 2048  #: of a task, whose words are counted in one table

_BOTH, _PIECES = 2, 3  # classes of words are 0 (text), 1 (edited) and 2 (as often in both); those from 3 on are pieces


def words(text: Column) -> Column:
    """Words of a text, and perhaps empty strings."""
    return F.split(F.lower(text), r"[\x20\x09-\x0D]+")


def sample_keys(word: Column, weight: Column, samples: int = SAMPLES) -> list[Column]:
    """A long for each sample: c v (v u)^t in the high bits, 16 bits of the identity of (word, t) in the low. ``word``: a hash."""
    out = []
    scale, mask = F.lit(float(1 << 38)), F.lit(0xFFFF).cast("long")

    def uniform(h: Column, at: int, bits: int) -> Column:
        return (F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) + F.lit(0.5)) * F.lit(2.0**-bits)

    for k in range(samples):
        h = F.xxhash64(word, F.lit(k))
        v, u = uniform(h, 0, 20), uniform(h, 20, 14)
        least = -(v * F.log(uniform(h, 34, 15) * uniform(h, 49, 15)))  # c v, between 2**-37 and 22
        r = -F.log(v * u)
        t = F.floor((F.log(weight) - F.log(u)) / r)
        own = F.shiftright(word, k % 48)
        first = F.shiftleft((least * scale).cast("long"), 16).bitwiseOR(own.bitwiseAND(mask))
        later = F.shiftleft((least * F.exp(-(r * t)) * scale).cast("long"), 16).bitwiseOR(own.bitwiseXOR(t).bitwiseAND(mask))
        out.append(F.when(weight * v < 1, first).otherwise(later))
    return out


def signature(keys: list[Column]) -> Column:
    """Hexadecimal: 4 digits for each sample."""
    return F.concat(*(F.lpad(F.lower(F.hex(F.coalesce(k, F.lit(0)).bitwiseAND(F.lit(0xFFFF).cast("long")))), 4, "0") for k in keys))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of samples at which two fingerprints agree."""
    same = sum((F.when(F.substring(a, 4 * k + 1, 4) == F.substring(b, 4 * k + 1, 4), 1).otherwise(0) for k in range(samples)), F.lit(0))
    return same / F.lit(float(samples))


def signed(texts: DataFrame, key: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """(key, fingerprint) of each row of ``texts``; rows without words are left out."""
    # Outer, as explode makes Spark split each text once more, to filter out empty ones.
    terms = texts.select(*key, F.explode_outer(words(F.col(text))).alias("_w")).where("_w <> ''").select(*key, F.xxhash64("_w").alias("_w"))
    counted = terms.groupBy(*key, "_w").agg(F.count("*").alias("_n"))
    least = counted.groupBy(*key).agg(*(F.min(c).alias(f"_s{k}") for k, c in enumerate(sample_keys(F.col("_w"), F.col("_n").cast("double"), samples))))
    return least.select(*key, signature([F.col(f"_s{k}") for k in range(samples)]).alias("fingerprint"))


def buckets_of(docs: DataFrame, doc_id: str, n: int) -> Column:
    """A column that numbers ranges of ``doc_id``, of nearly equal counts, in descending order; ``n``: rows.

    There are at most ``MAX_BUCKETS``, cut at quantiles; a null doc_id is in a last one.
    """
    number = max(1, min(MAX_BUCKETS, max(256, n // 1000), n))
    cuts = docs.agg(F.percentile_approx(F.col(doc_id), [i / number for i in range(1, number)], 10 * number)).first()[0] if number > 1 else None
    cuts = sorted(set(cuts or []))
    steps = [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]
    if not cuts:
        return F.when(F.col(doc_id).isNull(), 1).otherwise(0)
    # Binary search for how many cuts are at most doc_id; the cuts are folded into one literal.
    at = F.expr(f"aggregate(array({','.join(map(str, steps))}), 0, (a, s) -> if(a + s <= {len(cuts)} and get(from_json('{cuts}', 'array<bigint>'), a + s - 1) <= {doc_id}, a + s, a))")
    return F.when(F.col(doc_id).isNull(), len(cuts) + 1).otherwise(F.lit(len(cuts)) - at)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, rn, doc_id, text, next_text, next_bucket): each row with the next in descending order of doc_id; the first follows the last.

    Texts are shuffled once, by ranges of doc_id. The last row of a range gets the first of ``next_bucket``, which is null for all others.
    """
    n = docs.count()
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own.withColumn("bucket", buckets_of(own, "doc_id", n))
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text"), F.col("text")]
    w = Window.partitionBy("bucket").orderBy(*order)
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MAX_BUCKETS, n // ROWS))
    placed = own.repartition(parts, "bucket").withColumns({"rn": F.row_number().over(w), "next_text": F.lead("text").over(w)})
    tops = sorted(own.groupBy("bucket").agg(F.max("doc_id")).collect(), key=lambda r: r[0])  # MAX_BUCKETS + 1 rows at most
    follow = [{"bucket": b[0], "before": a[0], "top": b[1]} for a, b in zip(tops[-1:] + tops[:-1], tops)]
    pairs = local_rows(docs.sparkSession, follow, "bucket int, before int, top bigint")
    first = own.join(F.broadcast(pairs), "bucket").where(F.col("doc_id").eqNullSafe(F.col("top")))
    heads = first.withColumn("n", F.row_number().over(w)).where("n = 1").select(F.col("before").alias("_b"), F.col("bucket").alias("next_bucket"), F.col("text").alias("head_text"))
    joined = placed.join(heads, (F.col("bucket") == F.col("_b")) & F.col("next_text").isNull(), "left")
    return joined.select("bucket", "rn", "doc_id", "text", F.coalesce("next_text", "head_text").alias("next_text"), "next_bucket")


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    base = with_next(docs, doc_id, text)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    base = base.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
    sha = F.sha2(F.encode("edited", "UTF-8"), 256)
    eighths = [F.conv(F.substring(sha, 8 * k + 1, 8), 16, 10) for k in range(8)]
    pieces = [c.cast("string") for c in (F.col("doc_id"), n, F.col("next_bucket"), *eighths)]
    bodies = [F.col("text"), F.col("edited"), *pieces]
    kinds = [0, 1, *range(_PIECES, _PIECES + len(pieces))]
    rows = base.select("bucket", "rn", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), b.alias("body")) for k, b in zip(kinds, bodies)))).alias("s"))
    terms = rows.select("bucket", "rn", "s.kind", F.explode_outer(words(F.col("s.body"))).alias("_w")).where("_w <> ''")
    # One count for both texts: the edited one's in the high half.
    terms = terms.select(
        "bucket", (F.col("rn") * 16 + F.when(F.col("kind") < _BOTH, 0).otherwise(F.col("kind"))).alias("row"),
        F.when(F.col("kind") < _BOTH, F.xxhash64("_w")).otherwise(F.expr("try_cast(_w as bigint)")).alias("word"),
        F.when(F.col("kind") == 1, F.lit(1 << 32)).otherwise(F.lit(1)).cast("long").alias("one"),
    )
    counted = terms.groupBy("bucket", "row", "word").agg(F.sum("one").alias("c"))
    counted = counted.withColumns({"a": F.col("c").bitwiseAND(F.lit(0xFFFFFFFF)), "b": F.shiftright("c", 32), "kind": F.col("row").bitwiseAND(F.lit(15))})
    pair = lambda kind, c: F.struct(F.lit(kind).alias("kind") if isinstance(kind, int) else kind.alias("kind"), F.col(c).cast("double").alias("weight"))
    uses = (
        F.when(F.col("kind") >= _PIECES, F.array(pair(F.col("kind"), "a")))
        .when(F.col("a") == F.col("b"), F.array(pair(_BOTH, "a")))
        .when(F.col("b") == 0, F.array(pair(0, "a")))
        .when(F.col("a") == 0, F.array(pair(1, "b")))
        .otherwise(F.array(pair(0, "a"), pair(1, "b")))
    )
    each = counted.select("bucket", F.shiftright("row", 4).alias("rn"), "word", F.explode(uses).alias("u")).select("bucket", "rn", "word", "u.kind", "u.weight")
    names = [f"_s{k}" for k in range(samples)]
    least = each.groupBy("bucket", "rn", "kind").agg(*(F.min(c).alias(s) for s, c in zip(names, sample_keys(F.col("word"), F.col("weight"), samples))), F.min("word").alias("piece"))
    sides = least.select("bucket", "rn", F.explode(F.when(F.col("kind") == _BOTH, F.array(F.lit(0), F.lit(1))).otherwise(F.array("kind"))).alias("kind"), "piece", *names)
    sides = sides.groupBy("bucket", "rn", "kind").agg(*(F.min(s).alias(s) for s in names), F.min("piece").alias("piece"))
    prints = sides.select("bucket", "rn", "kind", "piece", F.when(F.col("kind") < _BOTH, signature([F.col(s) for s in names])).alias("f"))
    of = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c)))
    wide = prints.groupBy("bucket", "rn").agg(of(0, "f").alias("fp"), of(1, "f").alias("ep"), *(of(_PIECES + k, "piece").alias(f"p{k}") for k in range(len(pieces))))
    none = F.lit("0" * (4 * samples))
    in_bucket = Window.partitionBy("bucket").orderBy("rn")
    wide = wide.withColumns({"fp": F.coalesce("fp", none), "ep": F.coalesce("ep", none)}).withColumn("after", F.lead("fp").over(in_bucket))
    digest = F.concat(*(F.lpad(F.lower(F.hex(f"p{k}")), 8, "0") for k in range(3, 11)))
    own = written(wide.select("bucket", "rn", F.col("p0").alias("doc_id"), F.col("p1").alias("n_chars"), F.col("p2").cast("int").alias("next_bucket"), digest.alias("edited_sha256"), "fp", "ep", "after"), "fingerprints")  # short rows
    heads = own.where("rn = 1").select(F.col("bucket").alias("next_bucket"), F.col("fp").alias("head"))  # MAX_BUCKETS + 1 rows at most
    return own.join(F.broadcast(heads), "next_bucket", "left").select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"), "n_chars", "edited_sha256", F.col("fp").alias("fingerprint"), F.col("ep").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("ep"), samples).alias("near_edited"), likeness(F.col("fp"), F.coalesce("after", "head"), samples).alias("near_next"),
    )
