"""N-gram Jaccard join with several global token orders (operator 10).

A document's set holds the 64-bit hashes of its shingles of ``shingle`` words (3 in the query).  Documents with equal
sets form a class and go on as one.  If two sets of sizes s and t have a Jaccard similarity of q = ``percent``/100
(0.9 in the query) or more, they share a token among the first s - ceil(q s) + 1 (and t - ceil(q t) + 1)
tokens under *every* order of all tokens.  Three orders are used.  Tokens known to be common come last in all of them, the
commonest at the end; the rest follow three unrelated hashes.  A pair is verified only
if its prefixes meet under all three.

Classes first meet by neighbours.  Two unlike texts of a large corpus share some single token more often the larger
the corpus is, two tokens in a row hardly ever.  So the tokens of a set are put in the order of their hashes, and each makes a key with the one
that follows it (the last one with none).  A token that only one of two sets has takes away two keys at most from its own set and one from the
other; with i shared tokens 3 i - s - t keys at least are the same, so linked sets share (s + t) (2 q - 1) / (1 + q) keys,
and one among the first of the s of each, by the common tokens and the first hash again.  That is a prefix of
2 (1 - q) s + 1 keys.  With q = 0.5 or less it says nothing, and tokens are taken.

Which tokens are common is found by counting every token of the corpus, where
it stands in two documents of a task at least; tokens with HOT_SHARE of these
counts make the list (1/HOT_SHARE entries at most), which is sent to the tasks.  Any list
gives the same links: it only decides how soon unequal texts are told apart.

Classes that share a key in these prefixes meet by it, if it stands in two of them (a bitmap tells, ``picking.py``; the keys are made from the texts twice
rather than kept): groups of up to SMALL
classes as pairs (if their sizes allow a link), larger groups in blocks, where the filters run on
matrices.  A pair goes if the two sets' marks, of MARK_BITS bits, differ by more bits than linked sets by tokens; then it passes the
second and third order, in small groups one after the other, and in blocks if the sets are too large for their marks to tell much (the others pass them where
they are verified): so a class is sent about with its 64 bytes, and with its prefixes only if it may be close to another.  What is left, candidate links, falls into clusters (connected
components), and the texts of a cluster are sent once, or, beyond BLOCK members, in pairs of blocks dealt out by
hash.  There the filters and the verification run on matrices, so neither a
group nor its pairs stand in one place as rows; each task returns only the links that
join its documents (a spanning forest), which keeps every component.

Texts are picked for that by a bitmap of fixed size (``picking.py``), so that only
the wanted and some chance hits are shuffled; an exact join follows.

Edge cases: texts without words have empty sets, and are linked with nothing,
not even each other; fewer words than a shingle has are one shingle.  Null ids are never the smallest,
unless a group has no other (then its component_id is NULL).  Repeated rows are copies of each other.  No rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_place, byte_batches, in_arrow, shared_checkpoint, table, texts, written
from .components import components
from .picking import SALTS, bitmap_size, key_bitmap, matched, mix, picked, text_hashes
from .word_hashes import word_hashes

SHINGLE, PERCENT = 3, 90
RUN_BYTES, KEYED_BYTES = 8 << 20, 2 << 20
HOT_SHARE = 1 / 500_000
HOT_LEAST = 32
COUNT_TOKENS = 8 << 20
COUNT_CUTS = np.arange(1, 32, dtype=np.uint64) << np.uint64(59)  # of the range of hashes, for a run's tokens
SMALL = 32
BLOCK = 128
MARK_BITS, MARK_SHARE = 512, 0.35
MARKS = [f"m{k}" for k in range(MARK_BITS // 64)]
CELLS = 4 << 20
SIGNED_ROWS = 1024


def _folded(word: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of n words, in their order."""
    h = mix(word * SALTS[0])[:len(word) - n + 1] if n <= len(word) else np.zeros(0, np.uint64)
    for k in range(1, n):
        h = mix(h * SALTS[0] + mix(word[k:k + len(h)] + SALTS[1]) * SALTS[2])
    return h


def shingle_sets(data: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    word, ends = word_hashes([t.lower() for t in data])
    with np.errstate(over="ignore"):
        whole, out, start = _folded(word, shingle), [], 0
        for end in ends.tolist():
            n = end - start
            if n >= shingle:
                out.append(np.unique(whole[start:end - shingle + 1]))
            elif n:  # the whole sequence as one shingle
                out.append(_folded(word[start:end], n) + np.uint64(n))
            else:
                out.append(np.zeros(0, np.uint64))
            start = end
    return out


def class_id(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


class Orders:
    """The three global orders: place among the common tokens (0 for all others), then a hash."""

    def __init__(self, common: np.ndarray, counts: np.ndarray):
        by = np.argsort(common)
        self.common = common[by]
        self.place = np.empty(len(by), np.int64)
        self.place[np.lexsort((self.common, counts[by]))] = np.arange(1, len(by) + 1)

    def places(self, flat: np.ndarray) -> np.ndarray:
        """The place of each token among the common ones, 0 for all others."""
        if not len(self.common):
            return np.zeros(len(flat), np.int64)
        at = np.searchsorted(self.common, flat)
        at[at == len(self.common)] = 0
        return np.where(self.common[at] == flat, self.place[at], 0)

    def neighbours(self, sets: list[np.ndarray], percent: int = PERCENT) -> list[np.ndarray]:
        """The prefix of each set's (none empty) keys of neighbours; those of two common tokens come last."""
        if percent <= 50 or not sets:
            return self.prefixes(sets, percent, (0,))[0]
        flat = np.concatenate(sets)
        ends = np.cumsum([len(x) for x in sets])
        place = self.places(flat)
        with np.errstate(over="ignore"):
            after = np.append(mix(flat[1:] + SALTS[1]), np.uint64(0))
            after[ends - 1] = 0
            key = mix(flat * SALTS[0] + after * SALTS[2])
        beside = np.append(place[1:], 0)
        beside[ends - 1] = place[ends - 1]
        least = np.minimum(place, beside).astype(np.uint64)  # two keys of a set at most have the same place
        order = np.where(least == 0, key >> np.uint64(1), np.uint64(1 << 63) | least << np.uint64(40) | key >> np.uint64(24))
        out, start = [], 0
        for end in ends.tolist():
            n = end - start
            least_other = (percent * n + 99) // 100
            same = -(-(n + least_other) * (2 * percent - 100) // (100 + percent))
            size = n - same + 1
            own = order[start:end]
            out.append(key[start:end][np.argpartition(own, size - 1)[:size] if size < n else slice(None)])
            start = end
        return out

    def prefixes(self, sets: list[np.ndarray], percent: int = PERCENT, orders: tuple = (0, 1, 2)) -> list[list[np.ndarray]]:
        """For each of the orders, the prefix of each set (none empty), first token first."""
        out: list[list[np.ndarray]] = [[] for _ in orders]
        if not sets:
            return out
        flat = np.concatenate(sets)
        place = self.places(flat)
        with np.errstate(over="ignore"):
            keys = [mix(flat ^ SALTS[k]) for k in orders]
        start = 0
        for tokens in sets:
            n = len(tokens)
            size = n - (percent * n + 99) // 100 + 1
            own = place[start:start + n]
            rare = np.flatnonzero(own == 0)
            last = np.flatnonzero(own)
            last = last[np.argsort(own[last], kind="stable")][:max(0, size - len(rare))]  # common tokens, the commonest at the end
            for k in range(len(orders)):
                key = keys[k][start + rare]
                some = np.argpartition(key, size - 1)[:size] if size < len(rare) else np.arange(len(rare))
                out[k].append(tokens[np.concatenate((rare[some[np.argsort(key[some])]], last))])
            start += n
        return out

    def prefix(self, tokens: np.ndarray, order: int, percent: int = PERCENT) -> np.ndarray:
        return self.prefixes([tokens], percent)[order][0] if len(tokens) else tokens


def linked(a: np.ndarray, b: np.ndarray, shared: int, percent: int = PERCENT) -> bool:
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def marks(sets: list[np.ndarray]) -> np.ndarray:
    """MARK_BITS bits for each set, as 64-bit numbers: whether a range of hashes holds an odd number of its tokens.

    Two sets differ by as many tokens at least as their marks by bits.
    """
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    at = np.concatenate(sets) >> np.uint64(64 - MARK_BITS.bit_length() + 1) if sets else np.zeros(0, np.uint64)
    odd = np.bincount(of * MARK_BITS + at.astype(np.int64), minlength=len(sets) * MARK_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(sets), MARK_BITS // 64)


def may_link(mark: np.ndarray, size: np.ndarray, rows: np.ndarray, cols: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows and cols can be linked by their marks: of s + t tokens, those that differ are in one set alone."""
    bit = np.unpackbits(np.ascontiguousarray(mark).view(np.uint8).reshape(len(mark), MARK_BITS // 8), 1).astype(np.float32)
    n = bit.sum(1)
    differ = (n[rows][:, None] + n[cols] - 2 * (bit[rows] @ bit[cols].T)).astype(np.int64)
    both = size[rows][:, None] + size[cols]
    return (100 + percent) * (both - differ) >= 2 * percent * both


class Forest:
    """Union-find over the links that one task has seen."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.setdefault(x, x)) != x:
            self.up[x] = x = self.up[y]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.root(x), self.root(y)
        self.up[max(a, b)] = min(a, b)
        return a != b


def meetings(lists: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """How many tokens each of the lists ``rows`` shares with each of ``cols``; a bounded number of cells at a time."""
    sizes = [len(x) for x in lists]
    token, of, n = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    keep = n[of] > 1
    owner, column = np.repeat(np.arange(len(lists)), sizes)[keep], (np.cumsum(n > 1) - 1)[of[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(rows), len(cols)), np.float32)
    columns = int((n > 1).sum())
    width = max(1, CELLS // len(lists))
    for first in range(0, columns, width):
        a, b = np.searchsorted(column, (first, first + width))
        m = np.zeros((len(lists), min(width, columns - first)), np.float32)
        m[owner[a:b], column[a:b] - first] = 1
        out += m[rows] @ m[cols].T
    return out


def block_links(ids: list[int], left: np.ndarray, size: np.ndarray, prefixes: list[list[np.ndarray]], sets: list[np.ndarray] | None,
                percent: int = PERCENT, mark: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between the members marked ``left`` and the others (all members, if none is left).

    A pair passes the size filter (with ``mark`` that of ``marks`` too) and shares a token of every list of prefixes, unless one of the two is
    empty (left out); with ``sets`` it is verified.
    """
    rows, cols = (np.flatnonzero(left), np.flatnonzero(~left)) if left.any() and not left.all() else (np.arange(len(ids)),) * 2
    may = 100 * np.minimum(size[rows][:, None], size[cols]) >= percent * np.maximum(size[rows][:, None], size[cols])
    if rows is cols:
        may = np.triu(may, 1)
    if mark is not None and may.any():
        may &= may_link(mark, size, rows, cols, percent)
    for own in prefixes:
        if may.any():
            some = np.array([len(x) > 0 for x in own])
            may &= (meetings(own, rows, cols) > 0) | ~(some[rows][:, None] & some[cols])
    if sets is not None and may.any():
        shared = meetings(sets, rows, cols).astype(np.int64)
        may &= 100 * shared >= percent * (size[rows][:, None] + size[cols] - shared)
    forest = Forest()
    return [(x, y) for x, y in ((ids[rows[a]], ids[cols[b]]) for a, b in zip(*np.nonzero(may))) if x != y and forest.join(x, y)]


def _classes(shingle: int):
    def run(batches):
        for ids, data in byte_batches(batches, RUN_BYTES):
            sets = shingle_sets(data, shingle)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(text_hashes(data)),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([class_id(s) if len(s) else None for s in sets], pa.int64())],
                ["doc_id", "text_hash", "n_shingles", "class"])
    return run


def _counts(shingle: int):
    """Tokens that stand in two documents of a run of COUNT_TOKENS at least."""
    def flush(held):
        # sets are sorted: one range of hashes after the other, so that the tokens of a run are never held twice
        cuts = [[0, *np.searchsorted(s, COUNT_CUTS).tolist(), len(s)] for s in held]
        for k in range(len(COUNT_CUTS) + 1):
            token = np.concatenate([s[at[k]:at[k + 1]] for s, at in zip(held, cuts)])
            token.sort()
            first = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
            n = np.diff(first, append=len(token))
            yield pa.RecordBatch.from_arrays([pa.array(token[first[n > 1]].view(np.int64)), pa.array(n[n > 1])], ["token", "n"])
        held.clear()

    def run(batches):
        held, size = [], 0
        for _, data in byte_batches(batches, RUN_BYTES):
            for s in shingle_sets(data, shingle):
                held.append(s)
                size += len(s)
            if size > COUNT_TOKENS:
                yield from flush(held)
                size = 0
        if held:
            yield from flush(held)
    return run


def common_tokens(source: DataFrame, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    counts = source.select("doc_id", "text").transform(in_arrow, _counts(shingle), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counts = written(counts.filter(F.col("n") >= HOT_LEAST))
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.filter(F.col("n") >= F.lit(total * HOT_SHARE)).toArrow()  # at most 1 / HOT_SHARE rows
    return found.column("token").to_numpy().view(np.uint64), found.column("n").to_numpy()


def _prefixes(sent, shingle: int, percent: int):
    def run(batches):
        for _, data in byte_batches(batches, RUN_BYTES):
            sets = [x for x in shingle_sets(data, shingle) if len(x)]
            own = sent.value.prefixes(sets, percent, (1, 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_id(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int32()),
                 *[pa.array([x.view(np.int64).astype(np.int32) for x in prefixes], pa.list_(pa.int32())) for prefixes in own], *map(pa.array, marks(sets).T)],
                ["class", "size", "p1", "p2", *MARKS])
    return run


def _keyed(sent, shingle: int, percent: int):
    def run(batches):
        for _, data in byte_batches(batches, KEYED_BYTES):
            sets = [x for x in shingle_sets(data, shingle) if len(x)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_id(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int32()),
                 pa.array([x.view(np.int64) for x in sent.value.neighbours(sets, percent)], pa.list_(pa.int64()))], ["class", "size", "p0"])
    return run


def _by_group(names: list[str], links_of):
    """mapInArrow function over rows sorted by ``names``: links_of(columns of one group) -> links."""
    def run(batches):
        held: list[pa.RecordBatch] = []
        now = None

        def close():
            whole = pa.Table.from_batches(held)
            return _pairs(links_of({c: whole.column(c).to_pylist() for c in whole.column_names}))

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in names)))
            start = 0
            for i, key in enumerate(keys):
                if key != now:
                    if start < i:
                        held.append(batch.slice(start, i - start))
                    if held:
                        yield close()
                    held, start, now = [], i, key
            if start < len(keys):
                held.append(batch.slice(start))
        if held:
            yield close()
    return run


def _marked(columns: dict) -> np.ndarray:
    return np.array(columns["left"]) if columns["a"][0] != columns["b"][0] else np.zeros(len(columns["left"]), bool)


def _candidate_links(percent: int):
    def links_of(columns: dict) -> list[tuple[int, int]]:
        prefixes = [[np.array(x, np.int64) for x in columns[c]] for c in ("p1", "p2")]
        mark = np.array([columns[m] for m in MARKS], np.int64).T
        return block_links(columns["class"], _marked(columns), np.array(columns["size"], np.int64), prefixes, None, percent, mark)
    return links_of


def _dealt(members: DataFrame, key: str) -> DataFrame:
    """Rows (key, class, members, ..) repeated for each pair of blocks (a, b) they are part of; ``left``: in block a."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    return (members.withColumn("__own__", F.pmod(F.xxhash64("class"), blocks).cast("int"))
            .withColumn("__other__", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumns({"a": F.least("__own__", "__other__"), "b": F.greatest("__own__", "__other__"), "left": F.col("__own__") <= F.col("__other__")})
            .drop("__own__", "__other__", "members"))


def _in_groups(rows: DataFrame, names: list[str], links_of) -> DataFrame:
    return rows.repartition(*names).sortWithinPartitions(*names).transform(in_arrow, _by_group(names, links_of), "u long, v long")


def _met_tokens(sent, size: int):
    """token, class, size, at of the prefix tokens whose bit is set."""
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SIGNED_ROWS):
                part = batch.slice(start, SIGNED_ROWS)
                n = pc.list_value_length(part.column("p0")).to_numpy()
                token = part.column("p0").flatten().to_numpy()
                bit = token & (size - 1)
                keep = np.flatnonzero((sent.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                of = np.repeat(np.arange(len(n)), n)[keep]
                at = keep - (np.cumsum(n) - n)[of]
                yield pa.RecordBatch.from_arrays([pa.array(token[keep]), part.column("class").take(pa.array(of)), part.column("size").take(pa.array(of)), pa.array(at.astype(np.int32))],
                                                 ["token", "class", "size", "at"])
    return run


def prefix_rows(signed: DataFrame) -> DataFrame:
    """token, class, size, at of every first prefix's tokens (or keys) that stand in two rows, and of a few others.

    Tokens are counted first, alone; a bitmap of those that come twice (16 bits each up to MOST_BITS of ``picking.py``, beyond
    that more pass) picks the rows that are exchanged with their class.
    """
    counts = signed.select(F.explode("p0").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    twice = written(counts.filter("n > 1").select("token"))
    size = bitmap_size(twice.count())
    sent = signed.sparkSession.sparkContext.broadcast(key_bitmap(twice.select(F.col("token").bitwiseAND(F.lit(size - 1))), size))  # at most MOST_BITS bits
    return signed.select("class", "size", "p0").transform(in_arrow, _met_tokens(sent, size), "token long, class long, size int, at int")


def of_classes(signed: DataFrame, wanted: DataFrame, columns: tuple = ("class", "size", "p1", "p2")) -> DataFrame:
    """``columns`` of the rows of ``signed`` whose class is in ``wanted`` (class), and a few others: these alone are exchanged."""
    wanted = written(wanted.distinct())
    size = bitmap_size(wanted.count())
    sent = signed.sparkSession.sparkContext.broadcast(key_bitmap(wanted.select(F.col("class").bitwiseAND(F.lit(size - 1))), size))  # at most MOST_BITS bits

    def run(batches):
        for batch in batches:
            bit = batch.column("class").to_numpy() & (size - 1)
            yield batch.filter(pa.array((sent.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1))

    found = signed.select(*columns)
    return found.transform(in_arrow, run, found.schema)


KEYED = "class long, size int, p0 array<long>"
SIGNED = f"{KEYED}, p1 array<int>, p2 array<int>, " + ", ".join(f"{m} long" for m in MARKS)


def _once(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows' columns once for each class."""
    return rows.groupBy("class").agg(*(F.first(c).alias(c) for c in columns))


def _as(rows: DataFrame, end: str) -> DataFrame:
    return rows.toDF(*(end if c == "class" else f"{c}_{end}" for c in rows.columns))


def _close(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that sizes and ``marks`` let be linked, as a written table."""
    own = _once(of_classes(signed, pairs.select(F.explode(F.array("u", "v")).alias("class")), ("class", "size", *MARKS)), "size", *MARKS)
    differ = sum((F.bit_count(F.col(f"{m}_u").bitwiseXOR(F.col(f"{m}_v"))) for m in MARKS), F.lit(0))
    both = (F.col("size_u") + F.col("size_v")).cast("long")
    return written(pairs.join(_as(own, "u"), "u").join(_as(own, "v"), "v").filter((100 + percent) * (both - differ) >= 2 * percent * both).select("u", "v"))


def candidates(source: DataFrame, sent, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """u, v: pairs of classes that pass all filters, or for large groups links that join the same classes."""
    signed = written(source.transform(in_arrow, _prefixes(sent, shingle, percent), SIGNED.replace("p0 array<long>, ", "")))
    rows = (prefix_rows(source.transform(in_arrow, _keyed(sent, shingle, percent), KEYED)).select("token", "class", "size").repartition("token")
            .groupBy("token", "class").agg(F.max("size").alias("size")))
    groups = rows.groupBy("token").agg(F.count("*").alias("members"), F.max("size").alias("top")).filter("members > 1 and top > 0")
    met = written(rows.join(groups.drop("top"), "token"))

    small = met.filter(F.col("members") <= SMALL)
    x, y = small.alias("x"), small.alias("y")
    pairs = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.class") < F.col("y.class"))
                    & (100 * F.least("x.size", "y.size").cast("long") >= percent * F.greatest("x.size", "y.size").cast("long")))
             .select(F.col("x.class").alias("u"), F.col("y.class").alias("v")).distinct())
    pairs = _close(written(pairs), signed, percent)
    paired = of_classes(signed, pairs.select(F.explode(F.array("u", "v")).alias("class")))
    for p in ("p1", "p2"):
        own = paired.groupBy("class", p).agg(F.lit(1).alias("one")).drop("one")  # once for each class
        pairs = (pairs.join(own.toDF("u", "pu"), "u").join(own.toDF("v", "pv"), "v")
                 .filter(F.arrays_overlap("pu", "pv")).select("u", "v"))
    large = met.filter(F.col("members") > SMALL).select("token", "class", "members")
    own = _once(of_classes(signed, large.select("class"), ("class", "size", "p1", "p2", *MARKS)), "size", "p1", "p2", *MARKS)
    # linked sets may differ by so many tokens that the marks of others differ by no more bits; smaller sets go without prefixes
    wide = 2 * F.col("size").cast("long") * (100 - percent) > MARK_SHARE * MARK_BITS * (100 + percent)
    own = own.withColumns({p: F.when(wide, F.col(p)).otherwise(F.array().cast("array<int>")) for p in ("p1", "p2")})
    blocks = _in_groups(_dealt(large.join(own, "class"), "token"), ["token", "a", "b"], _candidate_links(percent))
    return pairs.unionByName(blocks)


def links(source: DataFrame, classes: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """u, v: links between classes that join every component."""
    context = source.sparkSession.sparkContext
    sent = context.broadcast(Orders(*common_tokens(source, shingle)))  # at most 1 / HOT_SHARE tokens
    clusters = components(candidates(source, sent, shingle, percent))
    clusters = shared_checkpoint(clusters.join(clusters.groupBy("component").agg(F.count("*").alias("members")), "component")
                                 .select(F.col("component").alias("cluster"), F.col("node").alias("class"), "members"))
    first = classes.filter("class is not null").groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("r"))
    chosen = shared_checkpoint(clusters.join(first, "class").select("cluster", "class", "members", F.col("r.doc_id").alias("doc_id"), F.col("r.text_hash").alias("text_hash")))
    near = picked(source, chosen)
    held = (near.join(chosen, near["doc_id"].eqNullSafe(chosen["doc_id"]) & (near["text_hash"] == chosen["text_hash"]))
            .select("cluster", "class", "members", "text"))

    def verified(columns: dict) -> list[tuple[int, int]]:
        one = dict(zip(columns["class"], range(len(columns["class"]))))  # repeated rows once
        at = list(one.values())
        sets = shingle_sets([columns["text"][i].encode() for i in at], shingle)
        prefixes = sent.value.prefixes(sets, percent)
        return block_links(list(one), _marked(columns)[at], np.array([len(x) for x in sets]), prefixes, sets, percent)

    return _in_groups(_dealt(held, "cluster"), ["cluster", "a", "b"], verified)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["u", "v"])


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept of every row; one text of each component has kept = true.

    Texts are linked whose sets of ``shingle``-word shingles have a Jaccard similarity of ``percent``/100 or more.
    """
    source = texts(docs, id_col, text_col)
    classes = shared_checkpoint(source.transform(in_arrow, _classes(shingle), "doc_id long, text_hash long, n_shingles long, class long"))
    joined = components(links(source, classes, shingle, percent))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    members = (classes.filter("class is not null").groupBy("class").agg(least.alias("first"))
               .join(joined.withColumnRenamed("node", "class"), "class", "left")
               .select("class", F.coalesce("component", "class").alias("component"), "first"))
    firsts = members.groupBy("component").agg(F.min("first").alias("least"))
    named = members.join(firsts, "component").select("class", "least")
    alone = classes.filter("class is null").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return (classes.join(named, "class")
            .select("doc_id", "text_hash", "n_shingles", F.col("least.doc_id").alias("component_id"),
                    (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))).alias("kept"))
            .unionByName(alone))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component stays, that with the smallest id, all columns as they were.

    Rows that repeat both the id and the text of the one that stays, stay with it (exact dedup goes before).
    """
    plain, own_id, own_text = by_place(docs, id_col, text_col)
    gone = written(near_groups(plain, own_id, own_text, shingle, percent).filter("not kept").select("doc_id", "text_hash").distinct())
    untouched, near = matched(plain, gone, own_id, own_text, "left_anti")
    return untouched.unionByName(near.select(*plain.columns)).toDF(*docs.columns)


def op10_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
