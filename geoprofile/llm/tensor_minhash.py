"""MinHash near-dedup with tensored banding (operator 13).

A document's set holds the 64-bit hashes of its shingles of ``shingle`` words (4 in the query); documents with equal sets form a class.
Two collections of BANDS bands, ROWS minhashes each, are computed: 2 * BANDS * ROWS values a class.  Every band of the first is
combined with every band of the second, so BANDS * BANDS tables with keys of 2 * ROWS minhashes come from 2 * BANDS bands, where
independent tables would need BANDS times as many minhashes.  Two sets of similarity s meet in some table with probability
(1 - (1 - s^ROWS)^BANDS)^2: at s = 0.8 all but 1 pair in 100,000, at 0.85 all but 1 in 2,000,000.

What meets is verified on the full sets: 100 * intersection >= ``percent`` * union (80 in the query).  Before that, pairs go whose sizes rule out a
link, or whose sketches do: one byte for each of BINS ranges of hashes, from the set's least hash there; the share of equal bytes estimates the
similarity with a standard error of 0.018 at most (sets far larger than BINS), 0.014 for 1,000 shingles, and estimates down to MARGIN percent
below the threshold are still verified: of pairs at 0.8, all but 1 in 30,000 to 1 in 1,000,000 pass, above 0.82 practically all.

Components are all that is asked for, so pairs are tried in two rounds:

1. of each class, the likeliest of its pairs with a representative (the least class of a key's group),
2. of pairs whose ends are not connected by now: the other pairs with representatives, and in each group the members outside its
   largest component with all others, in tasks of BLOCK by CHUNK members that hold sketches only.  A pair is looked at in the first table
   whose key it shares, and groups with the same members once.  A task does not tell these pairs, but which members they connect: clusters,
   whose texts are verified all with all, in one task or, as in operator 10, in pairs of blocks dealt out by hash.

So a group of M near copies costs some M pairs, however large it is; only members that are like nothing in a group are compared with
all of it, and no pair close to the threshold stands anywhere as a row.  Texts move for verification alone: in the first round each with its
representative's, in runs of RUN members, in the second with its cluster's or its block's.  Keys that occur once never meet a class: a bitmap of the others (16 bits each up to
MOST_BITS; beyond that more pass) picks the rows that are exchanged with their class.

Edge cases: texts without words have empty sets and are linked with nothing, not even each other; fewer words than a shingle has are one
shingle.  Null texts are empty.  Null ids are never the smallest, unless a component has no other (then component_id is NULL).  Repeated
rows are copies of each other; ``kept`` is true for each row that has its component's id.  No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, table, texts, written
from .components import components
from .ngram_join import _dealt, _in_groups, _marked, block_links, class_id, marks, shingle_sets
from .picking import SALTS, bitmap_size, key_bitmap, mix, picked, text_hashes

SHINGLE, PERCENT = 4, 80
BANDS, ROWS = 12, 2
HASHES = 2 * BANDS * ROWS
TABLES = BANDS * BANDS
BINS, MARGIN = 512, 7
RUN_BYTES = 4 << 20
KEY_ROWS = 16384
RUN = 256
BLOCK, CHUNK = 2048, 4096
TABLE_BITS = 8  # of a key, at its low end: its table
DEALT = ["key", "outside", "class", "component"]

_SEEDS = np.random.Generator(np.random.PCG64(13)).integers(0, 1 << 63, HASHES, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minhashes (32 bits of the least hash under each seed) for each of the sets, none empty."""
    out = np.empty((len(sets), HASHES), np.uint32)
    if sets:
        flat = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        for k, seed in enumerate(_SEEDS):
            with np.errstate(over="ignore"):
                out[:, k] = np.minimum.reduceat(mix(flat ^ seed), starts)  # the low half
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """2 * BANDS numbers of 32 bits for each signature, one for each band of the two collections."""
    with np.errstate(over="ignore"):
        value = signature.astype(np.uint64).reshape(len(signature), 2 * BANDS, ROWS)
        band = np.full(value.shape[:2], SALTS[1])
        for r in range(ROWS):
            band = mix(band * SALTS[0] + value[..., r])
    return band.astype(np.uint32)


def table_keys(band: np.ndarray) -> np.ndarray:
    """The TABLES keys of each row of bands: every band of the first collection with every band of the second."""
    with np.errstate(over="ignore"):
        value = band.astype(np.uint64)
        key = mix(((value[:, :BANDS, None] << np.uint64(32)) | value[:, None, BANDS:]) * SALTS[0] + SALTS[2]).reshape(len(band), TABLES)
    return (key >> np.uint64(TABLE_BITS) << np.uint64(TABLE_BITS)) | np.arange(TABLES, dtype=np.uint64)


def bins(sets: list[np.ndarray]) -> np.ndarray:
    """One byte for each of BINS equal ranges of hashes: 0 if the set has none there, else 1 to 255 from its least one."""
    out = np.zeros((len(sets), BINS), np.uint8)
    if sets:
        flat, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = of * BINS + (flat >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))  # sets are sorted
        out.ravel()[at[first]] = 1 + flat[first] % np.uint64(255)
    return out


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity in percent of the rows of two arrays of bins."""
    return 100 * ((a == b) & (a > 0)).sum(-1, dtype=np.int32) // np.maximum(((a | b) > 0).sum(-1, dtype=np.int32), 1)


def _unpacked(column, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _bands(column) -> np.ndarray:
    return _unpacked(column, np.uint32, 2 * BANDS)


def _bins(column) -> np.ndarray:
    return _unpacked(column, np.uint8, BINS)


def _signed(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, RUN_BYTES):
            data = part.column("text").cast(pa.binary()).to_pylist()
            sets = shingle_sets(data, shingle)
            some = [s for s in sets if len(s)]
            band, ranges = iter(bands(signatures(some))), iter(bins(some))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(text_hashes(data)), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([class_id(s) if len(s) else None for s in sets], pa.int64()),
                 *[pa.array([next(found).tobytes() if len(s) else None for s in sets], pa.binary()) for found in (band, ranges)]],
                ["doc_id", "text_hash", "n_shingles", "class", "bands", "bins"])
    return run


def _key_counts(batches):
    """key, n over a run of classes."""
    for batch in batches:
        for start in range(0, batch.num_rows, KEY_ROWS):
            key, n = np.unique(table_keys(_bands(batch.column("bands").slice(start, KEY_ROWS))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])


def _keys(sent, size: int):
    """key, class of the keys whose bit is set."""
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, KEY_ROWS):
                part = batch.slice(start, KEY_ROWS)
                keys = table_keys(_bands(part.column("bands"))).view(np.int64)
                at = (keys >> TABLE_BITS) & (size - 1)
                row, col = np.nonzero((sent.value[at // 8] >> (at % 8).astype(np.uint8)) & 1)
                yield pa.RecordBatch.from_arrays([pa.array(keys[row, col]), pa.array(part.column("class").to_numpy()[row])], ["key", "class"])
    return run


def meetings(classes: DataFrame) -> DataFrame:
    """key, class, least of every class in every key that two classes have; ``least`` is the key's least class.  A written table.

    The first exchange holds keys alone, counted in each task before; a bitmap of the repeated ones picks the rows of the second.
    """
    counts = classes.select("bands").mapInArrow(_key_counts, "key long, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
    shared = written(counts.filter("n > 1").select("key"))
    size = bitmap_size(shared.count())
    places = shared.select(F.shiftright("key", TABLE_BITS).bitwiseAND(F.lit(size - 1)))
    sent = classes.sparkSession.sparkContext.broadcast(key_bitmap(places, size))  # at most MOST_BITS bits
    rows = written(classes.select("class", "bands").mapInArrow(_keys(sent, size), "key long, class long"))
    groups = rows.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most")).filter("least <> most").select("key", "least")
    return written(rows.join(groups, "key"))


def _alike(percent: int):
    def run(batches):
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("size_u", "size_v"))
            share = alike(_bins(batch.column("bins_u")), _bins(batch.column("bins_v")))
            near = pa.array((100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (share >= percent - MARGIN))
            yield pa.RecordBatch.from_arrays([*[batch.column(c).filter(near) for c in ("u", "v")], pa.array(share.astype(np.int32)).filter(near)], ["u", "v", "share"])
    return run


def representatives(met: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """u, v, share: members v of a key's group that may be linked with its representative u, and their estimated similarity.  A written table."""
    facts = classes.select("class", "n_shingles", "bins")
    return written(met.filter(F.col("class") != F.col("least")).select(F.col("least").alias("u"), F.col("class").alias("v")).distinct()
                   .join(facts.toDF("u", "size_u", "bins_u"), "u").join(facts.toDF("v", "size_v", "bins_v"), "v").mapInArrow(_alike(percent), "u long, v long, share int"))


def _verifying(shingle: int, percent: int):
    """Links of rows sorted by (run, not u): the text of u comes first, then those of its members, one at a time."""
    def run(batches):
        now, u, held = None, None, None
        for part in sliced(batches, RUN_BYTES):
            found = []
            columns = (part.column(c).to_pylist() for c in ("run", "member", "class"))
            for key, member, one, own in zip(*columns, shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), shingle)):
                if not member:
                    now, u, held = key, one, own
                elif key == now:
                    at = np.searchsorted(held, own)
                    at[at == len(held)] = 0
                    both = int((held[at] == own).sum())
                    if 100 * both >= percent * (len(held) + len(own) - both):
                        found.append((u, one))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["u", "v"])
    return run


def verified(pairs: DataFrame, classes: DataFrame, source: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (u, v) that are links, as a written table.  ``pairs`` is a written table.

    The members of u are dealt to runs of about RUN, so a representative of any number of members is split.
    """
    runs = pairs.groupBy("u").agg(F.ceil(F.count("*") / RUN).alias("runs"))
    dealt = written(pairs.join(runs, "u").select("u", "v", F.xxhash64("u", F.pmod(F.xxhash64("v"), "runs")).alias("run")))  # read twice
    rows = (dealt.select(F.col("v").alias("class"), "run", F.lit(True).alias("member"))
            .unionByName(dealt.select(F.col("u").alias("class"), "run", F.lit(False).alias("member")).distinct()))
    rows = written(rows.join(classes.select("class", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash")), "class"))
    near = picked(source, rows)
    held = near.join(rows, near["doc_id"].eqNullSafe(rows["doc_id"]) & (near["text_hash"] == rows["text_hash"])).select("run", "member", "class", "text")
    return written(held.repartition("run").sortWithinPartitions("run", "member").mapInArrow(_verifying(shingle, percent), "u long, v long"))


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose ends are in two components."""
    named = [joined.select(F.col("node").alias(c), F.col("component").alias(f"in_{c}")) for c in ("u", "v")]
    return (pairs.join(named[0], "u", "left").join(named[1], "v", "left")
            .filter(F.coalesce("in_u", "u") != F.coalesce("in_v", "v")).select("u", "v"))


def _runs_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of each value of a sorted column, one table at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(cuts, cuts[1:]):
            if held and b > a and held[-1].column(column)[0].as_py() != key[a]:
                yield pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _crossing(percent: int):
    """u, v: rows of one task marked ``asks`` with those marked ``answers``, where components differ and sizes and bins allow a link.

    A pair is taken in the first table alone whose key both have, so no pair comes twice.
    """
    def run(batches):
        for rows in _runs_of(batches, "task"):
            first, second = divmod(rows.column("key")[0].as_py() & ((1 << TABLE_BITS) - 1), BANDS)
            asks, answers, outside = (rows.column(c).to_numpy() for c in ("asks", "answers", "outside"))
            one, component, size = (rows.column(c).to_numpy() for c in ("class", "component", "n_shingles"))
            band, ranges = _bands(rows.column("bands")), _bins(rows.column("bins"))
            others = np.flatnonzero(answers)
            found = []
            for i in np.flatnonzero(asks):
                at = others[(component[others] != component[i]) & (~outside[others] | (one[others] > one[i]))
                            & (100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i]))]
                same = band[at] == band[i]
                at = at[(same[:, :BANDS].argmax(1) == first) & (same[:, BANDS:].argmax(1) == second)]
                at = at[alike(ranges[at], ranges[i]) >= percent - MARGIN]
                found.append((np.minimum(one[at], one[i]), np.maximum(one[at], one[i])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["u", "v"])
    return run


def _connected(run):
    """Of each batch of pairs (u, v) of ``run``: every node that has any, as v, with the least node that they connect it to, as u."""
    def stars(batches):
        for pairs in run(batches):
            node, at = np.unique(np.concatenate([pairs.column(c).to_numpy() for c in ("u", "v")]), return_inverse=True)
            a, b = at[:pairs.num_rows], at[pairs.num_rows:]
            least = np.arange(len(node))
            while len(apart := np.flatnonzero(least[a] != least[b])):
                a, b = a[apart], b[apart]
                x, y = least[a], least[b]
                np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
                while (least[least] != least).any():
                    least = least[least]
            far = np.flatnonzero(least != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[least[far]]), pa.array(node[far])], ["u", "v"])
    return stars


def crossings(met: DataFrame, classes: DataFrame, joined: DataFrame, percent: int, connected: bool = False) -> DataFrame:
    """u, v of groups that are in several components: members outside the largest one with all others that may be linked.

    connected: not these pairs, but for each task fewer rows than members that connect the same members.
    Groups with the same members (known by count, sum and xor of their classes) are taken once, in their first table.
    """
    placed = written(met.select("key", "class").join(joined.withColumnRenamed("node", "class"), "class", "left")
                     .select("key", "class", F.coalesce("component", "class").alias("component")))
    # a group of two is finished: its one pair was its representative's
    open_ = placed.groupBy("key").agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high"),
                                      F.sum(F.col("class").cast("decimal(38,0)")).alias("sum"), F.bit_xor("class").alias("xor")).filter("low <> high and members > 2")
    once = written(open_.groupBy("members", "sum", "xor").agg(F.min_by("key", F.col("key").bitwiseAND((1 << TABLE_BITS) - 1)).alias("key")).select("key", "members"))
    if once.isEmpty():
        return once.select(F.col("key").alias("u"), F.col("key").alias("v"))
    parts = placed.join(once.select("key"), "key").groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = written(parts.groupBy("key").agg(F.max("n").alias("n"), F.max_by("component", F.struct("n", "component")).alias("largest"))
                      .join(once, "key").select("key", "largest", F.ceil((F.col("members") - F.col("n")) / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("members") / CHUNK).cast("int").alias("chunks")))
    rows = placed.join(largest, "key").withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int")).withColumn("chunk", F.pmod(F.xxhash64("class", F.lit(1)), "chunks").cast("int"))
    zero = F.lit(0)
    rows = rows.withColumn("outside", F.col("component") != F.col("largest"))
    # a member asks in every chunk of its block and answers in every block of its chunk; where both meet, one row does both
    asks = (rows.filter("outside").withColumn("other", F.explode(F.sequence(zero, F.col("chunks") - 1)))
            .select(*DEALT, "block", F.col("other").alias("chunk"), F.lit(True).alias("asks"), (F.col("other") == F.col("chunk")).alias("answers")))
    answers = (rows.withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1))).filter(~F.col("outside") | (F.col("other") != F.col("block")))
               .select(*DEALT, F.col("other").alias("block"), "chunk", F.lit(False).alias("asks"), F.lit(True).alias("answers")))
    dealt = asks.unionByName(answers).select(F.xxhash64("key", "block", "chunk").alias("task"), *DEALT, "asks", "answers")
    dealt = dealt.join(classes.select("class", "n_shingles", "bands", "bins"), "class")
    run = _crossing(percent)
    return dealt.repartition("task").sortWithinPartitions("task").mapInArrow(_connected(run) if connected else run, "u long, v long")


def cluster_links(edges: DataFrame, classes: DataFrame, source: DataFrame, shingle: int, percent: int) -> DataFrame:
    """u, v: links that join whatever is linked within a component of ``edges`` (u, v), as a written table."""
    clusters = written(components(edges).withColumnsRenamed({"node": "class", "component": "cluster"}))
    members = clusters.groupBy("cluster").agg(F.count("*").alias("members"))
    rows = written(clusters.join(members, "cluster").join(classes.select("class", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash")), "class"))
    near = picked(source, rows)
    held = near.join(rows, near["doc_id"].eqNullSafe(rows["doc_id"]) & (near["text_hash"] == rows["text_hash"])).select("cluster", "class", "members", "text")

    def links_of(columns: dict) -> list[tuple[int, int]]:
        one = dict(zip(columns["class"], range(len(columns["class"]))))  # repeated rows once
        at = list(one.values())
        sets = shingle_sets([columns["text"][i].encode() for i in at], shingle)
        return block_links(list(one), _marked(columns)[at], np.array([len(x) for x in sets]), [], sets, percent, marks(sets))

    return written(_in_groups(_dealt(held, "cluster"), ["cluster", "a", "b"], links_of))


def links(source: DataFrame, classes: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """node, component of all classes that are linked with another."""
    met = meetings(classes)
    classes = written(classes.join(written(met.select("class").distinct()), "class", "left_semi"))
    pairs = representatives(met, classes, percent)
    first = written(pairs.groupBy("v").agg(F.max_by("u", F.struct("share", "u")).alias("u")).select("u", "v"))
    found = verified(first, classes, source, shingle, percent)
    joined = written(components(found))
    others = pairs.select("u", "v").join(first, ["u", "v"], "left_anti")
    apart = written(_apart(others, joined).unionByName(crossings(met, classes, joined, percent, connected=True)))
    if apart.isEmpty():
        return joined
    return written(components(found.unionByName(cluster_links(apart, classes, source, shingle, percent))))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.  ``percent`` from 70 on: the tables are made for 80."""
    source = texts(docs, id_col, text_col)
    base = written(source.mapInArrow(_signed(shingle), "doc_id long, text_hash long, n_shingles long, class long, bands binary, bins binary"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    classes = written(base.filter("class is not null").groupBy("class").agg(least.alias("first"), F.max("n_shingles").alias("n_shingles"), F.max("bands").alias("bands"), F.max("bins").alias("bins")))
    joined = links(source, classes, shingle, percent)
    members = (classes.select("class", "first").join(joined.withColumnRenamed("node", "class"), "class", "left")
               .select("class", F.coalesce("component", "class").alias("component"), "first"))
    named = written(members.join(members.groupBy("component").agg(F.min("first").alias("least")), "component").select("class", F.col("least.doc_id").alias("component_id")))
    rows = base.select("doc_id", "n_shingles", "class")
    return (rows.join(named, "class").select("doc_id", "n_shingles", "component_id")
            .unionByName(rows.filter("class is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def op13_tensor_minhash(spark, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))
