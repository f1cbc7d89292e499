"""Suffix-array dedup: bytes in strings of 400 that stand elsewhere too are removed (operator 1).

Every string of LENGTH bytes (a window) has an anchor: the leftmost of its GRAM-byte grams with the least
hash.  Equal windows have equal anchors at the same place in them, so the
corpus is cut into shards by anchor, and only anchors that stand in two places matter:

1. anchors of all texts, distinct per text; those seen twice are kept,
2. their contexts, the bytes of the windows that the anchor stands for, are
   cut from one row of each text; equal contexts are counted, not copied,
3. contexts are dealt to shards by anchor, about SHARD contexts each.  A shard's suffix array
   (Larsson-Sadakane) and common prefixes (Kasai) tell which windows stand twice,
4. an anchor with more than SHARD different contexts is split over several
   shards.  Each of them gives every digest of its windows once, however many of its contexts
   hold it; digests that two shards give are counted with partial sums, and joined back to the
   windows that stand once in their own shard,
5. repeated windows return to their texts, whose covered bytes are removed.

``passages`` judges in words instead: each word of a text becomes a code of CODE bytes, its hash, and windows of
``words`` codes are searched in the same way, with codes as symbols in place of bytes.  op1's query gives
n_passages and n_passage_words besides what it removes by bytes: the maximal runs of WORDS words
that stand elsewhere too, and the words that they cover.

Texts with copies need no search: all their windows stand elsewhere.  They take part once, for the others.
Texts are known by 128 bits of hash, contexts likewise, split windows by 64 bits within one anchor.

Edge cases: texts shorter than LENGTH, empty or null lose nothing; bytes count,
so a removed run may begin or end inside a character (``strip_repeats`` drops
what is left of it); repeated rows are copies; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_place, byte_batches, in_arrow, shared_checkpoint, sliced, table, texts, written
from .picking import matched, picked, text_hashes
from .suffix_array import repeated_windows
from .word_hashes import word_hashes

LENGTH = 400
GRAM = 128
WORDS = 51
CODE = 8  # bytes of a word's code
SYMBOL = {1: np.dtype("u1"), CODE: np.dtype("<u8")}  # by the bytes of a unit
SHARD = 2048
PIECE = 1024
RUN_BYTES = 2 << 20
CODED_BYTES = 2 << 20  # texts of a batch that is coded or cut
PLACE_BITS = 24
PLACES = 40  # bits of a place in a text, beside its number in a batch
AT_ONCE = 1 << 15  # symbols of short texts that are hashed together: their arrays stay in a core's cache
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` bytes (8 or more), or of 64-bit codes, by doubling."""
    n = len(data)
    if n < size:
        return np.zeros(0, np.uint64)
    if data.itemsize == CODE:
        h, have = data.astype(np.uint64), 1
    else:
        h, have = np.ndarray((n - 7,), "<u8", data, strides=(1,)).astype(np.uint64), 8
    with np.errstate(over="ignore"):
        while True:
            h *= _ODD[0]
            h ^= h >> np.uint64(29)
            if have == size:
                h *= _ODD[1]
                return h
            step = min(have, size - have)
            ahead = h[step:] ^ _ODD[3]
            h = h[:-step] * _ODD[2]
            h += ahead
            have += step


def sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        key = np.minimum(key[:-step], key[step:])
        have += step
    return key


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM, unit: int = 1):
    """Arrays (gram hash, place, first window, last window) of the anchors of a text, all in units of ``unit`` bytes.

    A long text is taken in parts, so memory is bounded; an anchor whose windows lie in two parts comes twice.
    """
    out = []
    whole = np.frombuffer(text, SYMBOL[unit])
    for begin in range(0, len(whole) - length + 1, RUN_BYTES):
        data = whole[begin:begin + RUN_BYTES + length - 1]
        h = gram_hashes(np.ascontiguousarray(data), gram)
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = sliding_least((h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        out.append((h[place[first]].view(np.int64), place[first] + begin, first + begin, last + begin))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def all_anchors(data: list[bytes], length: int = LENGTH, gram: int = GRAM, unit: int = 1):
    """Arrays (number of the text, gram hash, place, first window, last window) of the ``anchors`` of each text in turn.

    Texts of under AT_ONCE symbols are taken many at a time; windows that reach into the next text are left out.
    """
    out = []
    sizes = [len(t) // unit for t in data]
    at = 0
    while at < len(data):
        end, total = at, 0
        while end < len(data) and (end == at or total + sizes[end] <= AT_ONCE):
            total += sizes[end]
            end += 1
        if total > AT_ONCE:  # one text
            found = anchors(data[at], length, gram, unit)
            out.append((np.full(len(found[0]), at), *found))
        elif of := [i for i in range(at, end) if sizes[i] >= length]:
            whole = np.frombuffer(b"".join([data[i] for i in of]), SYMBOL[unit])
            size = np.array([sizes[i] for i in of])
            start = np.cumsum(size) - size
            h = gram_hashes(whole, gram)
            low = np.uint64((1 << PLACE_BITS) - 1)
            least = sliding_least((h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
            windows = size - length + 1
            skipped = np.repeat(np.arange(len(of)) * (length - 1), windows)  # windows of texts before that reach too far
            window = np.arange(len(skipped)) + skipped
            place = (least[window] & low).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))  # two texts have no place in common
            text = skipped[first] // (length - 1)
            begin = start[text]
            last = np.append(first[1:], len(place)) - 1
            out.append((np.array(of)[text], h[place[first]].view(np.int64), place[first] - begin, window[first] - begin, window[last] - begin))
        at = end
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 5


def text_id(text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(text)


def symbols(data: list[bytes], unit: int) -> list[bytes]:
    """What texts, as bytes, are searched as: these, or the codes of what stands between white space, end to end."""
    if unit == 1:
        return data
    hashes, ends = word_hashes(data, unicode=True)
    codes, ends = hashes.astype("<u8").tobytes(), (ends * CODE).tolist()
    return [codes[a:b] for a, b in zip([0, *ends], ends)]


def _facts(with_words: bool):
    """What identifies a text: by its bytes, and with_words by its words' codes."""
    def run(batches):
        for ids, data in byte_batches(batches, CODED_BYTES):
            columns = [pa.array(ids, pa.int64()), pa.array(map(text_id, data), pa.binary()), pa.array(map(len, data), pa.int64()),
                       pa.array([hashlib.sha256(t).hexdigest() for t in data], pa.string()), pa.array(text_hashes(data))]
            names = ["doc_id", "tid", "n_bytes", "sha256", "text_hash"]
            if with_words:
                codes = symbols(data, CODE)
                columns += [pa.array(map(text_id, codes), pa.binary()), pa.array([len(c) // CODE for c in codes], pa.int64())]
                names += ["word_tid", "n_words"]
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def facts_of(source: DataFrame, with_words: bool) -> DataFrame:
    kinds = "doc_id long, tid binary, n_bytes long, sha256 string, text_hash long"
    return shared_checkpoint(source.transform(in_arrow, _facts(with_words), kinds + (", word_tid binary, n_words long" if with_words else "")))


def _anchor_rows(length: int, gram: int, unit: int):
    def run(batches):
        seen = set()
        for _, data in byte_batches(batches, RUN_BYTES):
            own = {}
            for text in symbols(data, unit):
                if len(text) >= length * unit and (tid := text_id(text)) not in seen:
                    seen.add(tid)
                    own[tid] = text
            if own:
                of, h, place, _, _ = all_anchors(list(own.values()), length, gram, unit)
                order = np.lexsort((h, of))  # a text that repeats itself has an anchor at many places: one row
                of, h = of[order], h[order]
                first = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (h[1:] != h[:-1]))))
                ends = pa.array(np.append(first, len(h)), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(list(own), pa.binary()).take(pa.array(of[first])),
                                                  pa.ListArray.from_arrays(ends, pa.array(place[order]))], ["anchor", "tid", "places"])
    return run


def _one_text(unit: int):
    """Of rows that share an id, the one with the wanted text, once."""
    def run(batches):
        seen = set()
        for batch in sliced(batches, CODED_BYTES):
            rows = []
            data = symbols(batch.column("text").cast(pa.binary()).to_pylist(), unit)
            for tid, places, text in zip(batch.column("tid").to_pylist(), batch.column("places").to_pylist(), data):
                if tid not in seen and text_id(text) == tid:
                    seen.add(tid)
                    rows.append((tid, places, text))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                                              pa.array([r[2] for r in rows], pa.binary())], ["tid", "places", "text"])
    return run


def _contexts(length: int, gram: int, unit: int, bodies: bool):
    """Contexts of the wanted anchors of each text, equal ones together."""
    def run(batches):
        for batch in sliced(batches, CODED_BYTES // 4):  # bodies overlap, so there is more to send than to read
            tids, data = (batch.column(c).to_pylist() for c in ("tid", "text"))
            of, h, place, first, last = all_anchors(data, length, gram, unit)
            wanted = np.repeat(np.arange(len(data)), batch.column("places").value_lengths().to_numpy()) << PLACES | batch.column("places").flatten().to_numpy()
            keep = np.isin(of << PLACES | place, wanted)
            own: dict = {}
            for i, a, x, y in zip(*(v[keep].tolist() for v in (of, h, first, last))):
                body = data[i][x * unit:(y + length) * unit]
                cid = xxhash.xxh3_128_digest(body)
                if (i, a, cid) in own:
                    own[i, a, cid][-1].append(x)
                else:
                    own[i, a, cid] = (body if bodies else None, [x])
            rows = [(a, cid, tids[i], body, starts) for (i, a, cid), (body, starts) in own.items()]
            columns = list(zip(*rows)) or [()] * 5
            out = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary())]
            out += [pa.array(columns[3], pa.binary()), pa.array(map(len, columns[4]), pa.int64())] if bodies else [pa.array(columns[2], pa.binary()), pa.array(columns[4], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, ["anchor", "cid", "body", "copies"] if bodies else ["anchor", "cid", "tid", "starts"])
    return run


def as_runs(found: np.ndarray) -> list[int]:
    """[begin, end, begin, end, ..] of the true runs."""
    return np.flatnonzero(np.diff(np.concatenate(([0], found.astype(np.int8), [0])))).tolist()


def whole_runs(key: np.ndarray, most: int) -> list[slice]:
    """Slices of about ``most`` places of a sorted array, none of which parts equal values."""
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
    cuts = starts[np.flatnonzero(np.diff(starts // most, prepend=-1))]
    return [slice(a, b) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)])]


def _shard(length: int, unit: int = 1):
    """Repeated windows of a shard's contexts, as runs; for split anchors also what the other shards need.

    lone and at: digests and offsets of a context's windows that stand once in the shard; known: each digest that
    stands here more often, once for all contexts of the anchor.  Equal windows have equal anchors, so a suffix array is
    made for about PIECE contexts with all others of their anchors at a time, which bounds its memory.
    """
    def run(members: pa.Table) -> pa.Table:
        anchor, bodies = members.column("anchor").to_numpy(), members.column("body").to_pylist()
        found = [np.zeros(len(b) // unit - length + 1, bool) for b in bodies]
        _, of, n = np.unique(anchor, return_inverse=True, return_counts=True)
        order = np.argsort(of, kind="stable")
        several = order[n[of[order]] > 1]  # a context alone with its anchor has no partner
        for piece in whole_runs(of[several], PIECE):
            own = several[piece].tolist()
            for i, f in zip(own, repeated_windows([bodies[i] for i in own], length, unit)):
                found[i] = f
        lone, at, known = ([[] for _ in bodies] for _ in range(3))
        twice: dict = {}
        for i in np.flatnonzero(members.column("parts").to_numpy() > 1).tolist():
            h = gram_hashes(np.frombuffer(bodies[i], SYMBOL[unit]), length).view(np.int64)
            lone[i], at[i] = h[~found[i]].tolist(), np.flatnonzero(~found[i]).tolist()
            twice.setdefault(anchor[i], (i, []))[1].append(h[found[i]])
        for i, own in twice.values():
            known[i] = np.unique(np.concatenate(own)).tolist()
        lists = [pa.array(x, pa.list_(pa.int64())) for x in ([as_runs(f) for f in found], lone, at, known)]
        return pa.table([members.column("anchor"), members.column("cid"), *lists], ["anchor", "cid", "runs", "lone", "at", "known"])
    return run


def covered(n: int, found: list, length: int) -> np.ndarray:
    """Which of n symbols lie in a repeated window; found: (starts of a context, runs of its repeated windows)."""
    edge = np.zeros(n + 1, np.int32)
    for starts, runs in found:
        starts, runs = np.asarray(starts, np.int64), np.asarray(runs, np.int64)
        np.add.at(edge, (starts[:, None] + runs[0::2]).ravel(), 1)
        np.add.at(edge, (starts[:, None] + runs[1::2] - 1).ravel() + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _strip(length: int, unit: int):
    def run(batches):
        for batch in sliced(batches, CODED_BYTES):
            rows = []
            for tid, text, found in zip(*(batch.column(c).to_pylist() for c in ("tid", "text", "found"))):
                data = np.frombuffer(text, SYMBOL[unit])
                gone = covered(len(data), [(f["starts"], f["runs"]) for f in found], length)
                runs = as_runs(gone)
                kept = data[~gone].tobytes()
                rows.append((tid, int(gone.sum()), len(runs) // 2, hashlib.sha256(kept).hexdigest(), runs))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)], ["tid", "n_removed", "n_spans", "kept_sha256", "gone"])
    return run


def stripped_texts(source: DataFrame, facts: DataFrame, length: int, gram: int, shard: int, unit: int = 1) -> DataFrame:
    """tid, n_removed, n_spans, kept_sha256, gone of every text that shares a window with another text, or has one twice.

    Texts are searched as symbols of ``unit`` bytes: their bytes, or codes of their words.  facts: doc_id, text_hash
    of the text and tid of its symbols.  Lengths and places count symbols.
    """
    rows = written(source.transform(in_arrow, _anchor_rows(length, gram, unit), "anchor long, tid binary, places array<long>")
                   .groupBy("anchor", "tid", "places").agg(F.size("places").alias("n")))
    # as a table of its own, so that the join shuffles both sides and adaptive execution can split a common anchor's rows
    twice = written(rows.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"))
    hits = rows.join(twice, "anchor").groupBy("tid").agg(F.flatten(F.collect_list("places")).alias("places"))
    carrier = facts.groupBy("tid").agg(F.min(F.struct("doc_id", "text_hash")).alias("r")).select("tid", "r.doc_id", "r.text_hash")
    wanted = shared_checkpoint(hits.join(carrier, "tid"))
    near = picked(source, wanted)
    held = written(near.join(wanted, near["doc_id"].eqNullSafe(wanted["doc_id"]) & (near["text_hash"] == wanted["text_hash"]))
                   .select("tid", "places", "text")
                    .transform(in_arrow, _one_text(unit), "tid binary, places array<long>, text binary"))

    bodies = (held.transform(in_arrow, _contexts(length, gram, unit, True), "anchor long, cid binary, body binary, copies long")
              .groupBy("anchor", "cid", "body").agg(F.sum("copies").alias("copies")))
    bodies = written(bodies)
    # the few anchors with more than a shard's contexts, as a table whose size the planner knows
    large = written(bodies.groupBy("anchor").agg(F.ceil(F.count("*") / shard).cast("int").alias("parts")).filter("parts > 1"))
    searched = bodies.join(large, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    shards = max(1, -(-bodies.count() // shard))
    part = F.pmod(F.xxhash64("cid"), F.col("parts"))
    by_shard = written(searched.select("anchor", "cid", "body", "parts", F.pmod(F.xxhash64("anchor", part), F.lit(shards)).alias("shard"))
                       .groupBy("shard").applyInArrow(_shard(length, unit), "anchor long, cid binary, runs array<long>, lone array<long>, at array<long>, known array<long>"))
    shared = written(by_shard.select("anchor", F.explode(F.concat("lone", "known")).alias("digest"))
                     .groupBy("anchor", "digest").agg(F.count("*").alias("shards")).filter("shards > 1").select("anchor", "digest"))
    split = (by_shard.select("anchor", "cid", F.explode(F.arrays_zip("lone", "at")).alias("w"))
             .select("anchor", "cid", F.col("w.lone").alias("digest"), F.col("w.at").alias("at")).join(shared, ["anchor", "digest"])
             .groupBy("anchor", "cid").agg(F.sort_array(F.collect_list("at")).alias("at"))
             .select("anchor", "cid", F.flatten(F.transform("at", lambda x: F.array(x, x + 1))).alias("runs")))
    by_shard = by_shard.select("anchor", "cid", "runs")
    copied = bodies.filter("copies > 1").select("anchor", "cid", F.array(F.lit(0).cast("long"), (F.floor(F.length("body") / unit) - length + 1).cast("long")).alias("runs"))
    found = by_shard.unionByName(split).unionByName(copied).filter(F.size("runs") > 0)

    places = held.transform(in_arrow, _contexts(length, gram, unit, False), "anchor long, cid binary, tid binary, starts array<long>")
    per_text = (places.join(found, ["anchor", "cid"]).groupBy("tid").agg(F.collect_list(F.struct("starts", "runs")).alias("found")))
    return (held.select("tid", "text").join(per_text, "tid")
            .transform(in_arrow, _strip(length, unit), "tid binary, n_removed long, n_spans long, kept_sha256 string, gone array<long>"))


def _by_text(source: DataFrame, facts: DataFrame, length: int, gram: int, shard: int, unit: int = 1) -> DataFrame:
    """tid, n_removed, n_spans, kept_sha256, gone, whole of the texts that lose something; facts: doc_id, tid, text_hash, size."""
    copied = facts.filter(F.col("size") >= length).groupBy("tid").agg(F.count("*").alias("copies")).filter("copies > 1").select("tid")
    # a text with copies goes as a whole, whatever the search has found for it
    return stripped_texts(source, facts, length, gram, shard, unit).join(copied.select("tid", F.lit(True).alias("whole")), "tid", "full")


def _lost(size: str) -> list:
    """n_removed, n_spans, gone of a row joined with its text's part of ``_by_text``."""
    return [F.when(F.col("whole"), F.col(size)).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(F.col("whole"), 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(F.col("whole"), F.array(F.lit(0).cast("long"), F.col(size))).otherwise(F.col("gone")).alias("gone")]


def _by_words(source: DataFrame, facts: DataFrame, words: int, shard: int) -> DataFrame:
    known = facts.select("doc_id", F.col("word_tid").alias("tid"), "text_hash", F.col("n_words").alias("size"))
    return _by_text(source, known, words, max(1, words // 3), shard, CODE).drop("kept_sha256").withColumnRenamed("tid", "word_tid")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, shard: int = SHARD,
            with_runs: bool = False, words: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    with_runs: also text_hash and gone ([begin, end, ..] of the removed bytes, NULL where nothing is removed).
    words: also n_passages and n_passage_words, as ``passages`` finds them; they change nothing of the rest.
    """
    source = texts(docs, id_col, text_col)
    facts = facts_of(source, words is not None)
    found = _by_text(source, facts.select("doc_id", "tid", "text_hash", F.col("n_bytes").alias("size")), length, gram, shard)
    empty = hashlib.sha256(b"").hexdigest()
    removed, spans, gone = _lost("n_bytes")
    out = facts.join(found if with_runs else found.drop("gone"), "tid", "left").select(
        "doc_id", "n_bytes", removed, spans, F.when(F.col("whole"), F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        *(["text_hash", gone] if with_runs else []), *(["word_tid", "n_words"] if words else []))
    if words is None:
        return out
    found = _by_words(source, facts, words, shard).drop("gone").withColumnsRenamed({"n_removed": "n_covered", "n_spans": "n_found"})
    return (out.join(found, "word_tid", "left")
            .withColumns({"n_passages": F.when(F.col("whole"), 1).otherwise(F.coalesce("n_found", F.lit(0))).cast("long"),
                          "n_passage_words": F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_covered", F.lit(0)))})
            .drop("word_tid", "n_words", "n_covered", "n_found", "whole"))


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, shard: int = SHARD) -> DataFrame:
    """doc_id, text_hash, n_words, n_passages, n_passage_words, gone ([begin, end, ..] by number of word, or NULL) of every row.

    Passages are the maximal runs covered by strings of ``words`` words that stand elsewhere too, in the same text or
    another one.  Words are what stands between white space, whose kind and length do not count.
    """
    source = texts(docs, id_col, text_col)
    facts = facts_of(source, True)
    covers, found, gone = _lost("n_words")
    return (facts.join(_by_words(source, facts, words, shard), "word_tid", "left")
            .select("doc_id", "text_hash", "n_words", found.alias("n_passages"), covers.alias("n_passage_words"), gone))


def _without(changed: DataFrame, docs: DataFrame, id_col: str, text_col: str, cut) -> DataFrame:
    """``docs``, named ``by_place``, with cut(text, gone) in ``text_col``; changed: doc_id, text_hash, gone."""
    def put(batches):
        for batch in sliced(batches, CODED_BYTES, text_col):
            i = batch.schema.get_field_index(text_col)
            gone = batch.column(batch.num_columns - 1).to_pylist()
            new = pa.array([t if g is None else cut(t, g) for t, g in zip(batch.column(i).to_pylist(), gone)], pa.string())
            columns = list(batch.columns)[:-1]
            columns[i] = new
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    # rows are exchanged before they are cut, however few they are: else each task holds two workers, which stay for later stages
    untouched, near = matched(docs, changed.hint("merge"), id_col, text_col)
    return untouched.unionByName(near.select(*docs.columns, "gone").transform(in_arrow, put, docs.schema))


def cut_bytes(text: str, gone: list[int]) -> str:
    data = text.encode()
    edges = [0, *gone, len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2])).decode("utf-8", "ignore")


def cut_words(text: str, gone: list[int]) -> str:
    """``text`` without its words number gone[0] up to gone[1], .., and what stands between these."""
    at = [m.span() for m in re.finditer(r"\S+", text)]
    edges = [0, *(x for a, b in zip(gone[0::2], gone[1::2]) for x in (at[a][0], at[b - 1][1])), len(text)]
    return "".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2]))


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the remaining text in ``text_col``, all other columns as they were; every row stays, also with an empty text.

    Where bytes of a broken character are left at a cut, they go too.
    """
    plain, own_id, own_text = by_place(docs, id_col, text_col)
    changed = written(repeats(plain, own_id, own_text, length, gram, with_runs=True).filter("n_removed > 0")
                      .select("doc_id", "text_hash", "gone").dropDuplicates(["doc_id", "text_hash"]))
    return _without(changed, plain, own_id, own_text, cut_bytes).toDF(*docs.columns)


def strip_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` without the words of all ``passages``; all other columns and all rows stay.

    White space inside a passage is cut with it and stays around it.
    """
    plain, own_id, own_text = by_place(docs, id_col, text_col)
    changed = written(passages(plain, own_id, own_text, words).filter("n_passages > 0")
                      .select("doc_id", "text_hash", "gone").dropDuplicates(["doc_id", "text_hash"]))
    return _without(changed, plain, own_id, own_text, cut_words).toDF(*docs.columns)


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"), words=WORDS)
