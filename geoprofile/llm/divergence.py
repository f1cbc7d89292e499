"""Source divergence audit by count-level bitmaps (operator 12).

Which sources of a language use its vocabulary unlike the others, and by which terms?  Terms are runs of ASCII letters
and of all code points beyond ASCII, A-Z lower-cased; a language keeps the V terms that stand in ``least_docs`` of its documents at
least.  A group (language, source) with N kept terms in all gives a term that occurs ``count`` times in it
p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)).

Since p depends on the count alone, the distance of two groups, the sum of abs(p - q) over all V terms, needs only the number of
terms for each pair of counts.  Terms are numbered by frequency and cut into blocks of BLOCK; for each (group, block, count) a bitset
tells which terms of the block have that count.  AND and a population count give the terms that share a pair of counts, the complement
of a group's bitsets those that it lacks (count 0); each cell is multiplied by abs(p - q).  In the blocks of
common terms counts are many and bitsets thin, in all others counts are few, so a block costs at most BLOCK * BLOCK cells a pair.

Texts are read twice: for the documents of each (language, term), then for the counts of the kept terms.  In the second pass a bitmap
(at least 16 bits for each kept term up to MOST_BITS; beyond that more terms pass) drops most other terms before the shuffle; an exact join follows.
A task of the pairs holds SUPER blocks of the sources of two parts (about PART sources each), however many documents there are.

All values are whole numbers: p is computed with decimals or Python integers, never with doubles.

Edge cases: null text, language or source count as ''.  A group without kept terms has p = 1 + floor(SCALE * SMOOTH / (SMOOTH * V)) for
each term; a language without kept terms has V = 0 and pairs of value 0, and no ``term`` rows.  A language with one source has no
``pair`` rows.  Equal values are ranked by the item in UTF-8 order.  Repeated rows are documents of their own.  No rows give no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import sliced, table, written

LEAST_DOCS = 30
SCALE, SMOOTH = 10**9, 5
TOP = 50
BLOCK, WORDS = 256, 4
SUPER = 8
PART = 64
CHUNK_CELLS = 1 << 20
HELD = 400_000
RUN_BYTES = 4 << 20
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27
BUCKET_BITS = 32768  # of Spark's bitmap functions

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()


def _rows(batches):
    """(lang, source, terms) of every row, null values as ''."""
    for part in sliced(batches, RUN_BYTES):
        names = (part.column(c).fill_null("").to_pylist() for c in ("lang", "source"))
        for lang, source, text in zip(*names, part.column("text").cast(pa.binary()).to_pylist()):
            yield lang, source, terms(text or b"")


def _document_counts(batches):
    """lang, term, docs: documents of a run with the term."""
    def flush(held):
        for lang, found in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()).cast(pa.string()),
                                              pa.array(list(found.values()), pa.int64())], ["lang", "term", "docs"])

    held: dict[str, Counter] = defaultdict(Counter)
    seen = 0
    for lang, _, found in _rows(batches):
        held[lang].update(set(found))
        seen += len(found)
        if seen > HELD:  # distinct terms are counted now and then only
            seen = 0
            if sum(map(len, held.values())) > HELD:
                yield from flush(held)
                held.clear()
    yield from flush(held)


def _bits(lang: str, found: list[bytes], size: int) -> np.ndarray:
    head = lang.encode() + b"\0"
    return (np.fromiter((xxhash.xxh3_64_intdigest(head + t) for t in found), np.uint64, len(found)) % np.uint64(size)).astype(np.int64)


def _term_counts(sent, size: int):
    """lang, source, term, count over a run, for terms whose bit is set."""
    def flush(held):
        for (lang, source), found in held.items():
            at = _bits(lang, list(found), size)
            keep = pa.array((sent.value[at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1)
            some = pa.array(list(found), pa.binary()).filter(keep).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()), some,
                                              pa.array(list(found.values()), pa.int64()).filter(keep)], ["lang", "source", "term", "count"])

    def run(batches):
        held: dict[tuple[str, str], Counter] = defaultdict(Counter)
        seen = 0
        for lang, source, found in _rows(batches):
            held[lang, source].update(found)
            seen += len(found)
            if seen > HELD:
                seen = 0
                if sum(map(len, held.values())) > HELD:
                    yield from flush(held)
                    held.clear()
        yield from flush(held)
    return run


def _bitmap(kept: DataFrame, size: int) -> np.ndarray:
    def bit(batches):
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            found = batch.column("term").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([int(_bits(x, [t], size)[0]) + 1 for x, t in zip(langs, found)], pa.int64())], ["bit"])

    out = np.zeros(size // 8, np.uint8)
    buckets = (kept.select("lang", "term").mapInArrow(bit, "bit long").groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")))
    for r in buckets.collect():  # at most MOST_BITS / BUCKET_BITS rows of 4 KB
        part = np.frombuffer(bytes(r.bits), np.uint8)
        out[(r.bucket - 1) * (BUCKET_BITS // 8):][:len(part)] = part
    return out


def term_cells(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, count of the kept terms, as a written table.  ``docs``: lang, source, text."""
    kept = written(docs.mapInArrow(_document_counts, "lang string, term string, docs long").groupBy("lang", "term")
                   .agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs).select("lang", "term"))
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * kept.count()).bit_length()))
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(kept, size))  # at most MOST_BITS bits
    counts = (docs.mapInArrow(_term_counts(sent, size), "lang string, source string, term string, count long")
              .groupBy("lang", "source", "term").agg(F.sum("count").alias("count")))
    return written(counts.join(kept, ["lang", "term"], "left_semi").select("lang", "source", "term", "count"))


def numbered(cells: DataFrame) -> DataFrame:
    """lang, term, total, block, bit: the kept terms by falling count; a block holds BLOCK numbers."""
    totals = cells.groupBy("lang", "term").agg(F.sum("count").alias("total"))
    number = F.monotonically_increasing_id()  # the partition in the high bits, so a block lies in one partition
    return written(totals.repartitionByRange("lang", F.desc("total"), "term").sortWithinPartitions("lang", F.desc("total"), "term")
                   .withColumn("number", number)
                   .select("lang", "term", "total", F.expr(f"number div {BLOCK}").alias("block"), F.expr(f"cast(number % {BLOCK} as int)").alias("bit")))


def _bitset() -> list:
    """The bitset of column ``bit`` over a group, as WORDS numbers of 64 bits."""
    return [F.expr(f"bit_or(if(bit div 64 = {w}, shiftleft(1L, bit % 64), 0L))").alias(f"w{w}") for w in range(WORDS)]


def share(count, n, v):
    """p of a count in a group of ``n`` kept terms and a vocabulary of ``v``; exact for counts up to 10^18."""
    above = F.lit(SCALE).cast("decimal(19,0)") * (count + SMOOTH).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", above, (n + F.lit(SMOOTH) * v).cast("decimal(19,0)"))


def _exact_share(count: int, n: int, v: int) -> int:
    return 1 + SCALE * (count + SMOOTH) // (n + SMOOTH * v)


class Levels:
    """Bitsets by count of some groups over one block: all levels in one array, groups as runs of it."""

    def __init__(self, groups: list[tuple[int, int, list]], mask: np.ndarray):
        bits, shares, starts = [], [], []
        for n, v, levels in groups:
            starts.append(len(shares))
            own = np.array([x[1:] for x in levels], np.int64).reshape(-1, WORDS).view(np.uint64)
            bits += [mask & ~np.bitwise_or.reduce(own, axis=0, initial=np.uint64(0)), *own]  # zeros by complement
            shares += [_exact_share(c, n, v) for c in (0, *(x[0] for x in levels))]
        self.bits, self.shares, self.starts = np.array(bits, np.uint64).reshape(-1, WORDS), np.array(shares, np.int64), np.array(starts + [len(shares)])

    def group(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[i:i + 2]
        return self.bits[a:b], self.shares[a:b]


def block_distances(left: Levels, i: int, right: Levels, first: int) -> np.ndarray:
    """The part of the block in the distance of group ``i`` of ``left`` and each group of ``right`` from ``first`` on."""
    bits, shares = left.group(i)
    at = right.starts[first]
    other, others = right.bits[at:], right.shares[at:]
    total = np.zeros(len(others), np.int64)
    step = max(1, CHUNK_CELLS // max(1, len(others)))
    for k in range(0, len(bits), step):
        shared = np.bitwise_count(bits[k:k + step, None, :] & other[None, :, :]).sum(-1, dtype=np.int64)
        total += (shared * np.abs(shares[k:k + step, None] - others)).sum(0)
    return np.add.reduceat(total, right.starts[first:-1] - at)


def _distances(batch: pa.Table) -> pa.Table:
    """u, v, value over the blocks of one (lang, super, a, b): each group of part a with each of part b, or those after it."""
    rows = batch.sort_by("source").to_pylist()
    lang = rows[0]["lang"]
    same = rows[0]["a"] == rows[0]["b"]
    sides = [rows, rows] if same else [[r for r in rows if r["left"]], [r for r in rows if not r["left"]]]
    sums = [np.zeros(len(sides[1]), np.int64) for _ in sides[0]]
    by_block = [{id(r): defaultdict(list) for r in rows}]
    for r in rows:
        for x in r["levels"] or ():
            by_block[0][id(r)][x["block"]].append((x["count"], *(x[f"w{w}"] for w in range(WORDS))))
    for m in rows[0]["masks"] or ():
        mask = np.array([m[f"w{w}"] for w in range(WORDS)], np.int64).view(np.uint64)
        held = [Levels([(r["n"], r["v"], by_block[0][id(r)][m["block"]]) for r in side], mask) for side in (sides[:1] if same else sides)]
        for i in range(len(sides[0])):
            first = i + 1 if same else 0
            if first < len(sides[1]):
                sums[i][first:] += block_distances(held[0], i, held[-1], first)
    found = [(r["source"], other["source"], int(sums[i][j])) for i, r in enumerate(sides[0]) for j, other in enumerate(sides[1]) if not same or i < j]
    return pa.table({"lang": pa.array([lang] * len(found), pa.string()), "u": pa.array([f[0] for f in found], pa.string()),
                     "v": pa.array([f[1] for f in found], pa.string()), "value": pa.array([f[2] for f in found], pa.int64())})


def pair_values(groups: DataFrame, cells: DataFrame, order: DataFrame) -> DataFrame:
    """lang, u, v, value for each two groups of a language, u before v or after it."""
    placed = cells.join(order, ["lang", "term"])
    levels = (placed.groupBy("lang", "source", "block", "count").agg(*_bitset())
              .groupBy("lang", "source", F.expr(f"block div {SUPER}").alias("super")).agg(F.collect_list(F.struct("block", "count", *[f"w{w}" for w in range(WORDS)])).alias("levels")))
    masks = (order.groupBy("lang", "block").agg(*_bitset())
             .groupBy("lang", F.expr(f"block div {SUPER}").alias("super")).agg(F.collect_list(F.struct("block", *[f"w{w}" for w in range(WORDS)])).alias("masks")))
    parts = groups.groupBy("lang").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    rows = (groups.join(parts, "lang").join(masks, "lang", "left").join(levels, ["lang", "source", "super"], "left")
            .withColumn("own", F.pmod(F.xxhash64("source"), "parts").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("lang", F.coalesce("super", F.lit(-1)).alias("super"), F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
                    (F.col("own") <= F.col("other")).alias("left"), "source", "n", "v", "levels", "masks"))
    return (rows.groupBy("lang", "super", "a", "b").applyInArrow(_distances, "lang string, u string, v string, value long")
            .groupBy("lang", "u", "v").agg(F.sum("value").alias("value")))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: distances to the other sources (``pair``) and the terms that a source has above its language (``term``)."""
    source = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    cells = term_cells(source, least_docs)
    order = numbered(cells)
    sizes = order.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    groups = written(source.select("lang", "source").distinct().join(cells.groupBy("lang", "source").agg(F.sum("count").alias("n")), ["lang", "source"], "left")
                     .join(sizes, "lang", "left").select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "lang_n")]))

    pairs = pair_values(groups, cells, order)
    both = pairs.select("lang", F.col("u").alias("source"), F.col("v").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("v").alias("source"), F.col("u").alias("item"), "value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = both.withColumn("rank", F.row_number().over(by)).withColumn("part", F.lit("pair"))

    above = (cells.join(order.select("lang", "term", "total"), ["lang", "term"]).join(groups, ["lang", "source"])
             .select("lang", "source", F.col("term").alias("item"), (share(F.col("count"), F.col("n"), F.col("v")) - share(F.col("total"), F.col("lang_n"), F.col("v"))).alias("value"))
             .filter("value > 0").withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top).withColumn("part", F.lit("term")))
    return ranked.unionByName(above).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))
