"""Packing into fixed windows by order-preserving dynamic programming (operator 7).

Documents keep the order in which they are read.  The token stream of a
partition is cut into blocks of 2^20 tokens; in each block a dynamic program
chooses the window cuts.  Cuts may lie at document ends (free), after sentence ends
(a small penalty for the truncation) and, in the last window of a block or
where no boundary comes in time, anywhere (a larger penalty).  With
f(j) the least cost of packing the block up to cut j,

    f(j) = truncation(j) + per_window + min over i of f(i) + padding(j - i),

where padding is window - length, or 0 if the length is a power of two.  For the first
kind the minimum of f(i) + position(i) over the last ``window`` tokens comes
from a monotone queue; the powers of two are looked up by position.

A block ends where it is full, so it packs alone: nothing is carried through one
task but its own stream, and no text is shuffled.  A window's number is made
of the partition, and its place in it, so it is the same after a retry.

Edge cases: a null or empty text is the closing id alone; a text longer than a
window or block runs on through several; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from itertools import compress, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import Numbers, byte_batches, in_arrow, kept, table, texts

WINDOW = 2048
BLOCK = 1 << 20
SENTENCE_CUT = 2
INNER_CUT = 12
PER_WINDOW = 6
END_ID = 1
RUN_BYTES = 2 << 20
CACHE_WORDS = 200_000
JOINED_WORDS = 1024
PLAIN = "\u00ff"  # letters up to here stay one letter each, whatever normalizing does
MARKS = b"!#$%&()*+,-./:;=?@[\\]^_`{|}~"  # ASCII signs that begin no match with letters, as an apostrophe does


class WordTokens:
    """Token ids of white-space separated words, each distinct word tokenized once.

    The vocabulary drops white space and letter case, and its pattern never matches across
    white space, so the ids of a text are those of its words in turn.  Nor does it match letters together with
    marks after them: the ids of a word of letters and marks at its end are those of the letters, then those of the marks.
    Words are tokenized many at a time.  Words of letters are one match each, so the token that ends a match ends a word; for
    others, offsets tell whose ids are whose.  A text that holds one of the file's
    control strings, which the tokenizer finds in the text as it is written, is given to it as a whole.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run side by side already
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True  # words are lower-cased, so what looks like a control string need not be one
        self.controls = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()
        self.sentence_ids = np.array(sorted(vocab[t] for t in (".</w>", "!</w>", "?</w>") if t in vocab), np.int32)
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[n for t, n in vocab.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.number = Numbers({b"": 0})  # the end of a text
        self.flat = np.array([END_ID], np.int32)
        self.start = np.array([0], np.int64)
        self.size = np.array([1], np.int64)
        self.met = np.zeros(1, np.int64)  # how often a word came

    def trim(self) -> None:
        """Keep the words that came most often, of those that came twice: half of CACHE_WORDS at most."""
        order = np.argsort(-self.met[1:], kind="stable")[:CACHE_WORDS // 2] + 1
        at = np.append(0, np.sort(order[self.met[order] > 1]))
        keep = np.zeros(len(self.number), bool)
        keep[at] = True
        words = list(compress(self.number, keep.tolist()))
        self.flat, ends = self._ids(at)
        self.size, self.met = self.size[at], self.met[at]
        self.start = ends - self.size
        self.number = Numbers(zip(words, range(len(words))))

    def _whole(self, text: bytes) -> np.ndarray:
        self.tokenizer.encode_special_tokens = False
        try:
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.int32)
        finally:
            self.tokenizer.encode_special_tokens = True

    def _joined(self, words: list[bytes], letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and how many each has."""
        joined = b" ".join(words).decode()
        if letters:
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.closes[ids])
            if len(ends) == len(words) and ends[-1] == len(ids) - 1:  # each word has one match at least, so each has one
                return ids, np.diff(ends, prepend=-1)
        found = self.tokenizer.encode(joined, add_special_tokens=False)
        spaces = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le"), np.uint32) == 32)
        first = np.fromiter((o[0] for o in found.offsets), np.int64)
        return np.array(found.ids, np.int32), np.bincount(np.searchsorted(spaces, first), minlength=len(spaces) + 1)

    def _tokenize(self, known: int) -> None:
        """Ids of all words from number ``known`` on, and of the parts that they are made of."""
        find = self.number.__getitem__
        kinds: tuple[list, list, list] = ([], [], [])  # whole texts, words of letters, other words
        made: list[tuple] = []  # number of a word, of its letters and of its marks
        for word in list(islice(self.number, known, None)):
            if isinstance(word, tuple):
                kinds[0].append(word)
                continue
            letters = word.rstrip(MARKS)
            text = "" if letters.isalpha() else letters.decode()
            if text and not text.isalpha() or not letters:
                kinds[2].append(word)
            elif len(letters) == len(word):
                kinds[1].append(word)
            elif text > "" and max(text) > PLAIN:
                kinds[2].append(word)
            else:
                before = len(self.number)
                own = find(letters)
                if len(self.number) > before:
                    kinds[1].append(letters)
                before = len(self.number)
                marks = find(word[len(letters):])
                if len(self.number) > before:
                    kinds[2].append(word[len(letters):])
                made.append((find(word), own, marks))
        flat, sizes = [], [self.size]
        order = [find(w) for kind in kinds for w in kind]
        for text, in kinds[0]:
            flat.append(self._whole(text))
            sizes.append([len(flat[-1])])
        for letters in (True, False):
            some = kinds[1 if letters else 2]
            for k in range(0, len(some), JOINED_WORDS):
                ids, n = self._joined(some[k:k + JOINED_WORDS], letters)
                flat.append(ids)
                sizes.append(n)
        self.size = np.concatenate((self.size, np.zeros(len(self.number) - known, np.int64)))
        self.start = np.concatenate((self.start, np.zeros(len(self.number) - known, np.int64)))
        if order:
            own_sizes = np.concatenate(sizes[1:])
            self.size[order] = own_sizes
            self.start[order] = len(self.flat) + np.cumsum(own_sizes) - own_sizes
        self.flat = np.concatenate((self.flat, *flat))
        if made:
            number, own, marks = np.array(made, np.int64).T
            size = self.size[own] + self.size[marks]
            self.start[number] = len(self.flat) + np.cumsum(size) - size
            self.size[number] = size
            self.flat = np.concatenate((self.flat, self._ids(np.stack((own, marks), 1).ravel())[0]))

    def _ids(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered words in turn, and the end of each word in them."""
        size = self.size[seen]
        ends = np.cumsum(size)
        at = np.repeat(self.start[seen] - (ends - size), size)
        at += np.arange(len(at))
        return self.flat[at], ends

    def encode(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, END_ID after each, and the end of each text in them."""
        if len(self.number) > CACHE_WORDS:
            self.trim()
        known = len(self.number)
        words = array("q")
        find = self.number.__getitem__
        for text in data:
            if b"<|" in text and any(c in text for c in self.controls):
                words.append(find((text,)))
            else:
                words.extend(map(find, text.lower().split()))
            words.append(0)
        if len(self.number) > known:
            self._tokenize(known)
        seen = np.frombuffer(words, np.int64)
        came = np.bincount(seen, minlength=len(self.number))
        came[:len(self.met)] += self.met
        self.met = came
        ids, ends = self._ids(seen)
        return ids, ends[seen == 0]


def candidates(length: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions of a block in order, 0 and its length among them, and the truncation penalty of each."""
    tail = np.arange(max(0, length - window), length + 1)
    cuts = np.unique(np.concatenate(([0], doc_ends, sentence_ends, tail)))
    gaps = np.flatnonzero(np.diff(cuts) > window // 2)
    if len(gaps):  # no boundary in time: cuts at regular places, so that every window can be closed
        more = [np.arange(cuts[g], cuts[g + 1], window // 16) for g in gaps]
        cuts = np.unique(np.concatenate((cuts, *more)))
    cost = np.full(len(cuts), INNER_CUT)
    cost[np.searchsorted(cuts, sentence_ends)] = SENTENCE_CUT
    cost[np.searchsorted(cuts, doc_ends)] = 0
    cost[-1] = 0
    return cuts, cost


def _power_hits(cuts: np.ndarray, window: int) -> dict[int, list[int]]:
    """For cuts that have any: the cuts a power of two before them; powers below 64 only in the last window."""
    length, hits = cuts[-1], {}
    for q in range(window.bit_length()):
        ends = np.arange(len(cuts)) if q >= 6 else np.flatnonzero(cuts > length - window)
        at = np.searchsorted(cuts, cuts[ends] - (1 << q))
        found = cuts[at] == cuts[ends] - (1 << q)
        for j, k in zip(ends[found].tolist(), at[found].tolist()):
            hits.setdefault(j, []).append(k)
    return hits


def best_cuts(cuts: list[int], cost: list[int], window: int = WINDOW) -> list[int]:
    """Window ends of least total cost; cuts are at most ``window`` apart."""
    total = [0] * len(cuts)
    back = [0] * len(cuts)
    hits = _power_hits(np.array(cuts), window)
    queue = deque([(0, 0, 0)])  # (f(i) + position(i), position(i), i), increasing
    for j in range(1, len(cuts)):
        p = cuts[j]
        while queue[0][1] < p - window:
            queue.popleft()
        best, _, i = queue[0]
        best += window - p
        if j in hits:
            for k in hits[j]:
                if total[k] < best:
                    best, i = total[k], k
        best += cost[j] + PER_WINDOW
        total[j], back[j] = best, i
        key = best + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    ends, j = [], len(cuts) - 1
    while j:
        ends.append(cuts[j])
        j = back[j]
    return ends[::-1]


class Packer:
    """Blocks of one partition's token stream."""

    def __init__(self, sentence_ids: np.ndarray, first: int, window: int, block: int):
        self.sentence_ids, self.sequence, self.window, self.block = sentence_ids, first, window, block
        self.parts: list[tuple] = []  # (doc_id, start in the document, ids, tokens of the document, whether it ends here)
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[list[tuple]]:
        start = 0
        while start < len(ids):
            take = min(len(ids) - start, self.block - self.size)
            self.parts.append((doc_id, start, ids[start:start + take], len(ids), start + take == len(ids)))
            self.size += take
            start += take
            if self.size == self.block:
                yield self.close()

    def close(self) -> list[tuple]:
        """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece of the block."""
        if not self.parts:
            return []
        stream = np.concatenate([p[2] for p in self.parts])
        part_ends = np.cumsum([len(p[2]) for p in self.parts])
        doc_ends = part_ends[[p[4] for p in self.parts]]
        sentence_ends = np.flatnonzero(np.isin(stream, self.sentence_ids)) + 1
        cuts, cost = candidates(len(stream), doc_ends, sentence_ends, self.window)
        ends = best_cuts(cuts.tolist(), cost.tolist(), self.window)
        raw = memoryview(stream.astype("<u4").tobytes())
        rows, part, opened, at = [], 0, 0, 0
        for end in ends:
            begin = at
            while at < end:
                doc_id, start, ids, total, _ = self.parts[part]
                length = min(opened + len(ids), end) - at
                rows.append((doc_id, start + at - opened, length, zlib.crc32(raw[4 * at:4 * (at + length)]), total, self.sequence, at - begin))
                at += length
                if at == opened + len(ids):
                    part, opened = part + 1, at
            self.sequence += 1
        self.parts, self.size = [], 0
        return rows


def _key(spec: str) -> tuple[str, bytes]:
    return __name__, hashlib.sha256(spec.encode()).digest()


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, spec: str, window: int = WINDOW, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; ``spec`` is the tokenizer file's content."""
    sent = docs.sparkSession.sparkContext.broadcast(spec)  # a vocabulary file of fixed size

    def run(batches):
        key = _key(sent.value)
        words = kept(key, lambda: WordTokens(sent.value))
        packer = Packer(words.sentence_ids, TaskContext.get().partitionId() << 33, window, block)

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                              [c.split()[0] for c in PIECES.split(", ")])

        for ids, data in byte_batches(batches, RUN_BYTES, key):
            stream, ends = words.encode(data)
            start = 0
            for doc_id, end in zip(ids, ends.tolist()):
                for rows in packer.add(doc_id, stream[start:end]):
                    yield out(rows)
                start = end
        if rows := packer.close():
            yield out(rows)

    return texts(docs, id_col, text_col).transform(in_arrow, run, PIECES)


def tokenizer_spec(path: str | None = None) -> str:
    import public_tokenizers
    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_spec())
