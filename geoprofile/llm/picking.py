"""Picking rows out of a large table without shuffling it.

The wanted rows, known by id and text hash, set bits in a bitmap of fixed size,
which is sent to the tasks; a row whose bit is not set is none of them.  What passes (the
wanted and chance hits) is then joined exactly.  With very many wanted rows
the bitmap fills up and lets more pass: results stay the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .common import byte_batches, in_arrow, sliced

BITS = 1 << 24
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27  # of bitmaps that are as large as their keys need
BUCKET_BITS = 32768  # of Spark's bitmap functions
RUN_BYTES = 8 << 20
SALTS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_hashes(data: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, data), np.uint64, len(data)).view(np.int64)


def row_bit(doc_id: np.ndarray, text_hash: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(doc_id.view(np.uint64) * SALTS[0] + text_hash.view(np.uint64)) >> np.uint64(8)).view(np.int64) % BITS


def bitmap(rows: DataFrame) -> np.ndarray:
    """Bitmap of BITS bits over rows (doc_id, text_hash), built from at most BITS / 32768 aggregated rows."""
    def bit(batches):
        for batch in batches:
            ids, hashes = (batch.column(c).fill_null(0).to_numpy() for c in ("doc_id", "text_hash"))
            yield pa.RecordBatch.from_arrays([pa.array(row_bit(ids, hashes) + 1)], ["bit"])

    found = (rows.select("doc_id", "text_hash").transform(in_arrow, bit, "bit long")
             .groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    out = np.zeros(BITS // 8, np.uint8)
    for r in found:
        part = np.frombuffer(bytes(r.bits), np.uint8)
        out[(r.bucket - 1) * 4096:(r.bucket - 1) * 4096 + len(part)] = part
    return out


def key_bitmap(places: DataFrame, size: int) -> np.ndarray:
    """``size`` bits, of which those at the values of the only column are set."""
    bit = F.col(places.columns[0]) + 1
    buckets = places.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for r in buckets.collect():  # at most size / BUCKET_BITS rows of 4 KB
        part = np.frombuffer(bytes(r.bits), np.uint8)
        out[(r.bucket - 1) * (BUCKET_BITS // 8):][:len(part)] = part
    return out


def bitmap_size(keys: int) -> int:
    """Bits for so many keys: 16 for each, from LEAST_BITS to MOST_BITS."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (16 * keys).bit_length()))


def _picking(bits):
    def run(batches):
        for ids, data in byte_batches(batches, RUN_BYTES):
            known = pa.array(ids, pa.int64())
            hashes = text_hashes(data)
            at = row_bit(known.fill_null(0).to_numpy(), hashes)
            keep = pa.array((bits.value[at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1)
            yield pa.RecordBatch.from_arrays([known.filter(keep), pa.array(hashes).filter(keep), pa.array(data, pa.binary()).filter(keep).cast(pa.string())],
                                             ["doc_id", "text_hash", "text"])
    return run


def picked(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, text_hash, text of all rows of ``source`` (doc_id, text) that ``wanted`` (doc_id, text_hash, ..) has, and a few others."""
    bits = source.sparkSession.sparkContext.broadcast(bitmap(wanted))  # BITS bits
    return source.transform(in_arrow, _picking(bits), "doc_id long, text_hash long, text string")


def matched(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, how: str = "left") -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` that ``wanted`` certainly lacks; and the others with their own_hash, joined with ``wanted``.

    docs: columns named ``by_place``; wanted: doc_id, text_hash and further columns, one row each.  Only the
    second part, the wanted rows and a few others, is shuffled.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted))  # BITS bits

    def run(batches):
        for batch in sliced(batches, RUN_BYTES, text_col):
            hashes = text_hashes([t or b"" for t in batch.column(text_col).cast(pa.binary()).to_pylist()])
            at = row_bit(batch.column(id_col).cast(pa.int64()).fill_null(0).to_numpy(), hashes)
            near = (bits.value[at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes), pa.array(near)], [*batch.schema.names, "own_hash", "near"])

    marked = docs.transform(in_arrow, run, StructType([*docs.schema.fields, StructField("own_hash", LongType()), StructField("near", BooleanType())]))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    return marked.filter("not near").select(*docs.columns), marked.filter("near").drop("near").join(wanted, same, how)
