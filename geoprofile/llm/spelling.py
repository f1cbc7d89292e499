"""Spelling variant grouping by sorted-list dynamic programming (operator 11).

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, with ``least_length`` code points and ``least_count`` occurrences at
least; all stand in Latin-1, one byte a code point, in whose order lists are sorted.  Two words are near if exactly one code point
is inserted, deleted or replaced.  A word's form is its near word with most occurrences, if it has FORM_RATIO times its own at least;
its root is the end of the chain of forms (which is short, as counts grow by that ratio at each step).

A query word is compared with a sorted list by rows of the banded edit matrix (three cells: one edit moves the diagonal by one at most).
Entries that share a prefix share its rows: at each depth the adjacent common prefixes (LCPs) cut a range of the list into the
ranges of the next code point, each gets one row computed from its parent's, and a range is skipped whole as soon as its shared prefix
exceeds one edit.

The edit lies in the first or in the second half of the word, so two sorted lists are scanned: of words, from the ranges that begin with the query's
first half, and of reversed words, from the ranges that end with its second half, where only words with another first half count.
Each list is cut by word order into shards of about SHARD entries; a query goes to each shard that its range reaches, unless the
prefix that the whole shard shares exceeds one edit.  A task returns one row for each of its queries (count and best near word), never
pairs.  Bounds of shards come from a sample of SAMPLE words at most, by hash; they only balance the work.

Edge cases: null texts have no words; a null id stands as '' before the colon of a marked word.  Rows that repeat are documents of their
own.  Near words with equal counts: the smallest in code-point order.  No words give no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, table, written

LEAST_LENGTH, LEAST_COUNT = 7, 2
FORM_RATIO = 10
MARKED = 31
HELD = 400_000
RUN_BYTES = 4 << 20
SHARD = 32768
SAMPLE = 65536
BOUND = 64  # code points of a bound
QUERIES = 1024  # queries of a task that are scanned at once
GUARD = 2  # more edits than a band cell tells apart

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    """Lower-cased words of a text in Latin-1; other code points part them."""
    return text.encode("latin-1", "replace").translate(_FOLD).split()


def marked(doc_id: int | None, word: bytes) -> bytes:
    """The word as it counts: where MARKED divides its document's checksum of it, one code point goes."""
    return _marked(zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode())), word)


def _marked(head: int, word: bytes) -> bytes:
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), head)
    if h % MARKED:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _counts(least_length: int):
    def run(batches):
        held: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for part in sliced(batches, RUN_BYTES):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                head = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                for word, n in Counter(w for w in words(text) if len(w) >= least_length).items():
                    word = _marked(head, word)
                    if len(word) >= least_length:
                        held[word] += n
            if len(held) > HELD:
                yield flush()
                held.clear()
        yield flush()
    return run


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word (Latin-1 bytes) and n, as a written table.  ``docs``: doc_id, text without nulls."""
    counts = docs.mapInArrow(_counts(least_length), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return written(counts.filter(F.col("n") >= least_count))


def after(prefix: bytes) -> bytes | None:
    """The least string beyond all that begin with ``prefix``; None if there is none."""
    cut = prefix.rstrip(b"\xff")
    return cut[:-1] + bytes([cut[-1] + 1]) if cut else None


def prefix_length(word: bytes, backward: bool) -> int:
    """Code points that a near word shares with the query at the list's sorted end."""
    return len(word) - len(word) // 2 if backward else len(word) // 2


def row_start(depth: int, length) -> tuple:
    """Cells of the banded row for an exact prefix: edits between it and the query's first depth - 1, depth, depth + 1 code points."""
    return 1, 0, np.where(depth + 1 <= length, 1, GUARD)


def next_row(a, b, c, same, depth: int, length):
    """The row after one more code point of the entry; same[k]: it equals the query's code point depth - 1 + k."""
    x = np.minimum(a + ~same[0], b + 1)
    y = np.minimum(np.minimum(b + ~same[1], c + 1), x + 1)
    z = np.minimum(c + ~same[2], y + 1)
    return tuple(np.where(depth + k <= length, np.minimum(v, GUARD), GUARD) for k, v in enumerate((x, y, z)))


def may_reach(query: bytes, prefix: bytes, depth: int) -> bool:
    """Whether a string that begins with ``prefix`` can be one edit from ``query``; both agree up to ``depth``."""
    a, b, c = (np.array([v], np.int8) for v in row_start(depth, np.array([len(query)])))
    for d in range(depth, min(len(prefix), len(query) + 1)):
        same = [np.array([0 <= d - 1 + k < len(query) and query[d - 1 + k] == prefix[d]]) for k in range(3)]
        a, b, c = next_row(a, b, c, same, d, len(query))
    return bool(min(a[0], b[0], c[0]) <= 1) and len(prefix) <= len(query) + 1


class SortedList:
    """A sorted list of words with their adjacent common prefixes."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.size = np.array([len(w) for w in entries], np.int64)
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.at = np.cumsum(self.size) - self.size
        self.lcp = np.zeros(len(entries), np.int64)
        open_ = np.arange(1, len(entries))
        least = np.minimum(self.size[1:], self.size[:-1])
        d = 0
        while len(open_):
            open_ = open_[least[open_ - 1] > d]
            open_ = open_[self.flat[self.at[open_] + d] == self.flat[self.at[open_ - 1] + d]]
            self.lcp[open_] += 1
            d += 1
        self.cut: dict[int, np.ndarray] = {}

    def starts(self, depth: int) -> np.ndarray:
        """Entries that share fewer than ``depth`` code points with the one before: where ranges of that depth begin."""
        if depth not in self.cut:
            self.cut = {d: x for d, x in self.cut.items() if d >= depth - 1}
            self.cut[depth] = np.append(np.flatnonzero(self.lcp < depth), len(self.entries))
        return self.cut[depth]

    def near(self, queries: list[bytes], depths: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(query, entry) numbers of all pairs one edit apart that share the query's first depths[i] code points."""
        length = np.array([len(q) for q in queries], np.int64)
        flat = np.frombuffer(b"\0" + b"\0\0".join(queries) + b"\0\0\0", np.uint8)  # guards that no entry holds
        at = np.cumsum(length + 2) - length - 1
        low = np.array([bisect_left(self.entries, q[:d]) for q, d in zip(queries, depths)], np.int64)
        high = np.array([bisect_left(self.entries, e) if (e := after(q[:d])) else len(self.entries) for q, d in zip(queries, depths)], np.int64)
        depth = np.array(depths, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        q = lo = hi = np.zeros(0, np.int64)
        a = b = c = np.zeros(0, np.int8)
        self.cut = {}
        for d in range(int(depth.min()), int(length.max()) + 2):
            new = np.flatnonzero((depth == d) & (low < high))
            if len(new):
                first = row_start(d, length[new])
                q, lo, hi = (np.append(x, y) for x, y in ((q, new), (lo, low[new]), (hi, high[new])))
                a, b, c = (np.append(x, np.broadcast_to(np.array(y, np.int8), len(new))) for x, y in zip((a, b, c), first))
            if not len(q):
                if d >= depth.max():
                    break
                continue
            ended = self.size[lo] == d  # the entry that is the shared prefix itself
            edits = np.select([length[q] == d - 1, length[q] == d, length[q] == d + 1], [a, b, c], GUARD)
            hit = ended & (edits == 1)
            found.append((q[hit], lo[hit]))
            lo = lo + ended
            # ranges of the next code point, one row each
            starts = self.starts(d + 1)
            first, last = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
            part = np.maximum(last - first, 0)
            of = np.repeat(np.arange(len(q)), part)
            child = np.arange(len(of)) - np.repeat(np.cumsum(part) - part, part) + first[of]
            q, lo, hi = q[of], starts[child], np.minimum(starts[child + 1], hi[of])
            letter, here = self.flat[self.at[lo] + d], at[q] + d
            same = [flat[np.minimum(here - 1 + k, at[q] + length[q])] == letter for k in range(3)]
            a, b, c = next_row(a[of], b[of], c[of], same, d, length[q])
            alive = np.minimum(np.minimum(a, b), c) <= 1
            q, lo, hi, a, b, c = (x[alive] for x in (q, lo, hi, a, b, c))
        pairs = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 2
        return pairs[0], pairs[1]


def scan(rows: pa.Table, backward: bool) -> pa.Table:
    """word, n, n_near, best_n, best for each query of one shard.  Rows: word (reversed in the backward list), n, entry (or a query alone)."""
    rows = rows.sort_by("word")
    entries = rows.filter(rows.column("entry"))
    held, counts = SortedList(entries.column("word").to_pylist()), entries.column("n").to_numpy()
    asked = rows.column("word").to_pylist()
    near, best_n, best = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64), [None] * len(asked)
    for start in range(0, len(asked), QUERIES):
        some = asked[start:start + QUERIES]
        if not held.entries:
            break
        q, e = held.near(some, [prefix_length(w, backward) for w in some])
        if backward:  # pairs that share the first half too are the forward list's
            other = np.array([some[i][len(some[i]) - len(some[i]) // 2:] != held.entries[j][len(held.entries[j]) - len(some[i]) // 2:] for i, j in zip(q, e)], bool)
            q, e = q[other], e[other]
        near[start:start + len(some)] = np.bincount(q, minlength=len(some))
        for i, j in zip(q.tolist(), e.tolist()):
            word, n = held.entries[j][::-1] if backward else held.entries[j], counts[j]
            if n > best_n[start + i] or (n == best_n[start + i] and word < best[start + i]):
                best_n[start + i], best[start + i] = n, word
    return pa.table({"word": pa.array([w[::-1] for w in asked] if backward else asked, pa.binary()), "n": rows.column("n"),
                     "n_near": pa.array(near), "best_n": pa.array(best_n), "best": pa.array(best, pa.binary())})


def _scanning(backward: bool):
    def run(rows: pa.Table) -> pa.Table:
        return scan(rows, backward)
    return run


def bounds(listed: DataFrame, total: int) -> list[bytes]:
    """Words at which the sorted list is cut, so that a shard holds about SHARD entries."""
    every = max(1, -(-total * 2 // SAMPLE))
    sample = listed.filter(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select(F.substring("word", 1, BOUND).alias("word"))  # about SAMPLE / 2 words
    found = sorted(r.word for r in sample.collect())
    step = max(1, round(SHARD / every))
    return sorted({bytes(w) for w in found[step::step]})


def _shared(a: bytes, b: bytes) -> bytes:
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:n]


def _dealing(cuts: list[bytes], backward: bool):
    """Entries with their shard, and queries for other shards that their range reaches."""
    def shards(word: bytes):
        own, depth = bisect_right(cuts, word), prefix_length(word, backward)
        yield own, True
        prefix = word[:depth]
        beyond = after(prefix)
        for s in range(bisect_right(cuts, prefix), (bisect_left(cuts, beyond) if beyond else len(cuts)) + 1):
            if s != own:
                # a shard within one prefix lies between its two bounds; the first and the last share nothing for sure
                inner = _shared(cuts[s - 1], cuts[s]) if 0 < s < len(cuts) else b""
                if len(inner) <= depth or may_reach(word, inner, depth):
                    yield s, False

    def run(batches):
        for batch in batches:
            dealt = [(s, i, entry) for i, word in enumerate(batch.column("word").to_pylist()) for s, entry in shards(word)]
            at = pa.array([d[1] for d in dealt], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in dealt], pa.int32()), batch.column("word").take(at), batch.column("n").take(at),
                                              pa.array([d[2] for d in dealt], pa.bool_())], ["shard", "word", "n", "entry"])
    return run


def near_words(known: DataFrame) -> DataFrame:
    """word, n, n_near, best_n, best of every word of a written table (word binary, n)."""
    total = known.count()
    sides = []
    for backward in (False, True):
        listed = known.select(F.reverse(F.decode("word", "ISO-8859-1")).alias("word"), "n").select(F.encode("word", "ISO-8859-1").alias("word"), "n") if backward else known
        dealt = listed.mapInArrow(_dealing(bounds(listed, total), backward), "shard int, word binary, n long, entry boolean")
        sides.append(dealt.groupBy("shard").applyInArrow(_scanning(backward), "word binary, n long, n_near long, best_n long, best binary"))
    first = F.min(F.when(F.col("best_n") > 0, F.struct((-F.col("best_n")).alias("less"), "best")))
    return (sides[0].unionByName(sides[1]).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), first.alias("first"))
            .select("word", "n", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """word and root for a written table (word, form) without cycles; each round doubles the steps."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        step = now.select(F.col("word").alias("via"), F.col("root").alias("further"))
        now = written(now.join(step, F.col("root") == F.col("via"), "left")
                      .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the corpus."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = near_words(vocabulary(source, least_length, least_count))
    named = written(found.select("word", "n", "n_near", F.when(F.col("best_n") >= FORM_RATIO * F.col("n"), F.struct(F.col("best").alias("form"), F.col("best_n").alias("form_n"))).alias("f"))
                    .select("word", "n", "n_near", "f.form", "f.form_n"))
    ended = roots(named.filter("form is not null").select("word", "form"))
    text = lambda c: F.decode(c, "ISO-8859-1")
    return (named.join(ended, "word", "left")
            .select(text("word").alias("word"), text("form").alias("form"), text(F.coalesce("root", "word")).alias("root"), "n", "n_near", "form_n"))


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
