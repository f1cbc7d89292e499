"""Document fingerprints by consistent weighted sampling (operator 3, DataFrame operations only).

A text's terms are its lower-cased (A-Z) words, weighted by their counts.  For a term
of weight w and sample k, with r and c drawn from Gamma(2, 1) and b from U(0, 1), all
by hashing (term, k),

    t = floor(ln w / r + b),   ln a = ln c - r (t - b + 1),

and the sample is the term and t of the least a.  Two texts share it with a
probability equal to their generalised Jaccard similarity, sum(min) / sum(max) of the
weights.  Since a is a continuous function of term and t, the least a itself names the sample:
fingerprints hold 32 bits of its hash per sample, and the aggregation is a
plain minimum over numbers.

The next document in descending id order comes from a window over ranges of
ids.  The ranges are cut at approximate percentiles (RANGES_PER_PARTITION for
each shuffle partition), so none holds more than its share; the first row
of each range is handed to the range before it.  Texts are shuffled once, and all
aggregations of words run inside these ranges.

Edge cases: a text without words has the empty fingerprint, which is like
another empty one (1.0) and unlike any other (0.0).  Null ids come last; rows with the same
id are ordered by a hash of their texts; a single row is its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_checkpoint, table, texts

SAMPLES = 32
PER_CHUNK = 8
RANGES_PER_PARTITION = 4
LEAST_ID = -(1 << 63)


def _unit(bits: Column) -> Column:
    """32 bits to (0, 1)."""
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 32))


def _low(h: Column) -> Column:
    return h.bitwiseAND(F.lit((1 << 32) - 1))


def _high(h: Column) -> Column:
    return F.shiftrightunsigned(h, 32)


def _gamma(h: Column) -> Column:
    """Gamma(2, 1) from a 64-bit hash: the sum of two exponentials."""
    return -F.ln(_unit(_low(h)) * _unit(_high(h)))


def _local(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of longs written as literals."""
    if not rows:
        return spark.range(0).select(*[F.lit(0).cast("long").alias(n) for n in names])
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(r, names)]) for r in rows])))


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """range, pos, g (place in the whole order from 1), doc_id, text and next_text of every row; and the number of rows."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(LEAST_ID)).alias("key"), F.xxhash64("text").alias("tie"))
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = keyed.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] or []
    bounds = F.array(*[F.lit(b).cast("long") for b in sorted(set(found))]).cast("array<long>")
    keyed = keyed.withColumn("range", F.size(F.filter(bounds, lambda b: b >= F.col("key"))))
    # one row per range, at most RANGES_PER_PARTITION for each shuffle partition
    stats = sorted(keyed.groupBy("range").agg(F.count("*").alias("n"), F.max(F.struct("key", "tie")).alias("first")).collect())
    offsets, heads, rows = [], [], 0
    for i, s in enumerate(stats):
        offsets.append((s["range"], rows))
        heads.append((s["range"], s["first"]["key"], s["first"]["tie"], stats[i - 1]["range"]))
        rows += s["n"]
    head = _local(spark, heads, ["range", "key", "tie", "to"])
    given = (keyed.join(F.broadcast(head), ["range", "key", "tie"]).groupBy("to").agg(F.max("text").alias("text"))
             .select(F.col("to").cast("int").alias("range"), F.lit(None).cast("long").alias("doc_id"), "text",
                     F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("tie"), F.lit(1).alias("given")))
    order = Window.partitionBy("range").orderBy("given", F.desc("key"), F.desc("tie"))
    out = (keyed.withColumn("given", F.lit(0)).select("range", "doc_id", "text", "key", "tie", "given").unionByName(given)
           .select("range", "doc_id", "text", "given", F.row_number().over(order).alias("pos"), F.lead("text").over(order).alias("next_text"))
           .filter("given = 0").drop("given")
           .join(F.broadcast(_local(spark, offsets, ["range", "offset"])), "range")
           .select("range", "pos", (F.col("offset") + F.col("pos")).alias("g"), "doc_id", "text", "next_text"))
    return out, rows


def samples(words: DataFrame, keys: list[str], weights: list[str], n: int = SAMPLES) -> DataFrame:
    """The n samples of each column of weights, for each key, as array<long> columns of the same names.

    ``words`` has one row per key and ``term`` (a 64-bit hash).
    """
    rows = words.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n // PER_CHUNK - 1))))
    rows = rows.select(*keys, "chunk", "term", *[F.when(F.col(w) > 0, F.ln(F.col(w).cast("double"))).alias(w) for w in weights])
    names = [(j, f"h{j}", f"r{j}", f"b{j}", f"c{j}") for j in range(PER_CHUNK)]
    rows = rows.select("*", *[F.xxhash64("term", "chunk", F.lit(j)).alias(h) for j, h, _, _, _ in names])
    rows = rows.select(*keys, "chunk", *weights, *[x for _, h, r, b, c in names for x in (
        _gamma(F.col(h)).alias(r), _unit(_low(F.xxhash64(h, F.lit(1)))).alias(b), F.ln(_gamma(F.xxhash64(h, F.lit(2)))).alias(c))])
    least = [F.min(F.col(c) - F.col(r) * (F.floor(F.col(w) / F.col(r) + F.col(b)) - F.col(b) + 1)).alias(f"{w}{j}")
             for w in weights for j, _, r, b, c in names]
    part = rows.groupBy(*keys, "chunk").agg(*least)

    def packed(w):
        return F.array(*[F.when(F.col(f"{w}{j}").isNotNull(), _low(F.xxhash64(f"{w}{j}"))) for j in range(PER_CHUNK)])

    listed = part.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("chunk", *[packed(w).alias(w) for w in weights]))).alias("all"))
    return listed.select(*keys, *[F.flatten(F.col(f"all.{w}")).alias(w) for w in weights])


def likeness(a: Column, b: Column, n: int = SAMPLES) -> Column:
    """Share of equal samples; texts without words are like each other alone."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(n)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same)


def written(a: Column) -> Column:
    return F.coalesce(F.concat_ws("", F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))), F.lit(""))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    ordered, rows = with_next(texts(docs, id_col, text_col))
    n, cut = F.length("text"), F.expr("length(text) - length(text) div 3").cast("int")
    space = r"(?s)^(.*[\x20\x09-\x0D])"
    parts = ordered.select("range", "pos", "g", "doc_id", "text", n.alias("n_chars"), cut.alias("cut"),
                           F.expr("substring(next_text, 1, int(length(text) div 3))").alias("head"))
    whole = parts.select("range", "pos", "g", "doc_id", F.col("n_chars").cast("long").alias("n_chars"),
                         F.sha2(F.concat(F.substr("text", F.lit(1), F.col("cut")), F.col("head")), 256).alias("edited_sha256"))
    # words up to the last space before the cut stand in both texts and are counted once for both
    both = parts.withColumn("both", F.length(F.regexp_extract(F.substr("text", F.lit(1), F.col("cut")), space, 1)))
    segment = F.explode(F.array(
        F.struct(F.substr("text", F.lit(1), F.col("both")).alias("t"), F.lit(1).alias("own"), F.lit(1).alias("edited")),
        F.struct(F.substr("text", F.col("both") + 1).alias("t"), F.lit(1).alias("own"), F.lit(0).alias("edited")),
        F.struct(F.concat(F.substr("text", F.col("both") + 1, F.col("cut") - F.col("both")), F.col("head")).alias("t"),
                 F.lit(0).alias("own"), F.lit(1).alias("edited"))))
    lower = F.translate(F.col("s.t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     ")
    # with the id among the keys both branches need the same columns, so the texts' exchange is made once
    keys = ["range", "pos", "doc_id"]
    words = (both.select(*keys, segment.alias("s"))
             .select(*keys, "s.own", "s.edited", F.explode(F.split(lower, " ")).alias("word"))
             .filter("word <> ''")
             .groupBy(*keys, F.xxhash64("word").alias("term")).agg(F.sum("own").alias("own"), F.sum("edited").alias("edited")))
    found = samples(words, keys, ["own", "edited"])
    done = shared_checkpoint(whole.join(found.select("range", "pos", "own", "edited"), ["range", "pos"], "left")
                             .select("g", "doc_id", "n_chars", "edited_sha256", F.col("own"), F.col("edited")))
    own = F.when(F.col("own")[0].isNotNull(), F.col("own"))
    edited = F.when(F.col("edited")[0].isNotNull(), F.col("edited"))
    done = done.select("g", "doc_id", "n_chars", "edited_sha256", own.alias("own"), edited.alias("edited"))
    after = done.select(F.when(F.col("g") == 1, F.lit(rows)).otherwise(F.col("g") - 1).alias("g"), F.col("own").alias("next_own"))
    return (done.join(after, "g")
            .select("doc_id", "n_chars", "edited_sha256", written(F.col("own")).alias("fingerprint"), written(F.col("edited")).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next")))


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
