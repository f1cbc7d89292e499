"""Exact dedup by content-defined chunk recipes (operator 9).

Every text is cut into chunks at positions that its bytes choose, so equal
texts have equal chunks.  A chunk's identifier is its 64-bit digest and length.
Identifiers are verified: each chunk body is shuffled once, and a
digest under which two different bodies meet is reported.  Two texts are equal when
their ordered identifier lists are equal; chunks under a reported digest add
their bodies to the list, so a digest that collides cannot merge two texts.
Long documents move once, as chunk bodies; groups are formed on the lists.

Edge cases: a null text equals the empty text and has an empty list.  Null ids
lose against any other id; a group of null ids alone has keep_id NULL.  Rows with the same
id and text are separate members of their group, and exactly one row of a
group has kept = true.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_place, byte_batches, in_arrow, shared_checkpoint, table, texts, written
from .picking import matched, text_hashes

MIN_CHUNK = 512
MAX_CHUNK = 16384
CUT_BITS = 10
WINDOW = 16
BLOCK = 1 << 20
RUN_BYTES = 8 << 20

_GEAR = np.random.Generator(np.random.PCG64(9)).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_candidates(data: bytes) -> np.ndarray:
    """Ends of chunks that the bytes propose: the rolling hash of the last 16 bytes has ten leading zero bits."""
    raw = np.frombuffer(data, np.uint8)
    found = []
    for start in range(0, len(raw), BLOCK):
        lead = min(start, WINDOW - 1)
        h = _GEAR[raw[start - lead:start + BLOCK]]
        step = 1
        while step < WINDOW:
            g = h.copy()
            g[step:] += h[:-step] << np.uint32(step)
            h, step = g, step * 2
        found.append(np.flatnonzero(h[lead:] < np.uint32(1 << (32 - CUT_BITS))) + (start + 1))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(length: int, candidates: list[int]) -> list[int]:
    """Greedy cuts at candidates, at least MIN_CHUNK and at most MAX_CHUNK apart."""
    ends, last = [], 0
    for c in candidates:
        while c - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if c - last >= MIN_CHUNK and c < length:
            ends.append(c)
            last = c
    while length - last > MAX_CHUNK:
        last += MAX_CHUNK
        ends.append(last)
    if length > last:
        ends.append(length)
    return ends


def chunked(data: list[bytes]) -> Iterator[list[bytes]]:
    """The chunks of each text; all texts of the run are hashed in one buffer."""
    cuts = cut_candidates(b"".join(data))
    start = 0
    for text in data:
        if len(text) <= MIN_CHUNK:
            yield [text] if text else []
        else:
            a, b = np.searchsorted(cuts, (start + MIN_CHUNK, start + len(text)))
            ends = chunk_ends(len(text), (cuts[a:b] - start).tolist())
            yield [text[x:y] for x, y in zip([0, *ends], ends)]
        start += len(text)


def digest(chunk: bytes, bits: int) -> int:
    h = xxhash.xxh3_64_intdigest(chunk) & ((1 << bits) - 1)
    return h - (1 << 64) if h >> 63 else h


def _bodies(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data in byte_batches(batches, RUN_BYTES):
            seen = {c for chunks in chunked(data) for c in chunks}
            bodies = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(c, bits) for c in bodies], pa.int64()), pa.array([len(c) for c in bodies], pa.int64()),
                 pa.array(bodies, pa.binary())], ["digest", "length", "body"])
    return run


def _recipes(bits: int, collided: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data in byte_batches(batches, RUN_BYTES):
            lists, extra = [], []
            for chunks in chunked(data):
                names = [(digest(c, bits), len(c)) for c in chunks]
                lists.append([x for name in names for x in name])
                extra.append([c for c, name in zip(chunks, names) if name in collided])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lists, pa.list_(pa.int64())), pa.array(extra, pa.list_(pa.binary())),
                 pa.array([hashlib.sha256(t).hexdigest() for t in data]), pa.array(text_hashes(data))],
                ["doc_id", "recipe", "bodies", "text_sha256", "text_hash"])
    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 64, with_hash: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (and text_hash).

    The list of colliding digests is the only thing sent to the tasks; with n
    distinct chunks it has about n^2 / 2^65 entries (about 100 at 100 TB).
    """
    source = texts(docs, id_col, text_col)
    collided = (source.transform(in_arrow, _bodies(digest_bits), "digest long, length long, body binary")
                .repartition("digest", "length").groupBy("digest", "length", "body").agg(F.lit(1).alias("one"))
                .groupBy("digest", "length").count().filter("count > 1").select("digest", "length"))
    clash = frozenset((r.digest, r.length) for r in collided.collect())
    rows = (source.transform(in_arrow, _recipes(digest_bits, clash),
                              "doc_id long, recipe array<long>, bodies array<binary>, text_sha256 string, text_hash long")
            .groupBy("recipe", "bodies", "doc_id", "text_sha256", "text_hash").agg(F.count("*").alias("copies")))
    rows = shared_checkpoint(rows)
    # groups of more than one row as a table of their own: the join then shuffles both sides, and adaptive
    # execution can split the rows of a large group
    groups = shared_checkpoint(rows.groupBy("recipe", "bodies").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
                               .filter("group_size > 1"))
    return (rows.join(groups, ["recipe", "bodies"], "left")
            .select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), "text_sha256", "text_hash", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
            .select("doc_id", "keep_id", "group_size",
                    ((F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256", *(["text_hash"] if with_hash else [])))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    plain, own_id, own_text = by_place(docs, id_col, text_col)
    found = exact_dedup(plain, own_id, own_text, with_hash=True)
    shared = written(found.filter("group_size > 1").select("doc_id", "text_hash", "kept"))
    # repeated rows, the same id and text, are one
    known = shared.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("kept"), (F.count("*") > 1).alias("several"))
    untouched, near = matched(plain, known, own_id, own_text)
    stay = near.filter("kept is null or kept")
    one = stay.filter("several").groupBy("doc_id", "text_hash").agg(F.first(F.struct(*plain.columns)).alias("row")).select("row.*")
    return untouched.unionByName(stay.filter("not coalesce(several, false)").select(*plain.columns)).unionByName(one).toDF(*docs.columns)


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))
