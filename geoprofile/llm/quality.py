"""Quality classifier from weak labels (operator 5).

Nine overlapping heuristics vote on each text: good, bad or no vote.  Expectation
maximisation over the counts of vote patterns estimates each heuristic's
accuracy per class and the share of good texts, without any given label.  A
pattern's posterior labels the texts that show it, and those labels train a
linear scorer on hashed features (word shapes, repetition and variety of the text in
coarse steps), which scores every text, those on which all heuristics are silent too.

Variety is the share of distinct words, in a text of BLOCK or more words the mean over all its blocks of BLOCK
words, so that length does not count; the last block ends with the text and may overlap the one before it.
All word shapes are features; of one with more than SHAPE signs the rest becomes one of SHAPE_RESTS numbers.

The pattern counts cover all rows; there are at most 3^9 patterns, so they fit
on the driver whatever the input.  The scorer is fitted on at most
``max_rows`` rows, taken by the hash of their id (a documented parameter).

Edge cases: a null or empty text gets no votes, the prior as its posterior and
the feature "empty"; no rows give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_batches, table, texts, written
from .linear import Rows, feature, fit, sigmoid

MAX_ROWS = 12_000
RUN_BYTES = 16 << 20
MEMO_WORDS = 300_000
LEAST_WORDS = 20
BLOCK = 400
SHAPE, SHAPE_RESTS = 12, 64
EM_ROUNDS = 200

# Each heuristic's measure, with the bounds that vote bad and good.
HEURISTICS = (
    ("symbols", "above", 0.08, 0.03), ("variety", "below", 0.30, 0.50), ("repeats", "above", 0.10, 0.02),
    ("capitals", "above", 0.30, 0.10), ("line_ends", "below", 0.40, 0.70), ("marked_words", "above", 0.10, 0.01),
    ("top_word", "above", 0.25, 0.12), ("word_length", "above", 7.5, 6.5), ("loose_symbols", "above", 0.10, 0.01),
)
_LETTERS, _CAPITALS, _SHAPE = re.compile(r"[^\W\d_]"), re.compile(r"[A-Z]"), re.compile(r"(.)\1+")
_MARKED = re.compile(r"[^\w\s]{2,}$")


def word_facts(word: str) -> tuple[str, int, int, bool, bool]:
    """Shape, letters, capitals, whether it ends in marks, whether it is marks alone."""
    bare, end = (word, "") if word[-1].isalpha() else (word[:-1], word[-1])
    if bare.isalpha() and not end.isalnum() and (bare.islower() or bare[0].isupper() and (len(bare) == 1 or bare[1:].islower())):
        high = not bare.islower()  # most words: letters, of which the first may be a capital, and a mark perhaps
        return ("A" if high else "") + ("a" if len(bare) > high else "") + end, len(bare), int(high), False, False
    letters = len(_LETTERS.findall(word))
    shape = _SHAPE.sub(r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word))
    if len(shape) > SHAPE:
        shape = f"{shape[:SHAPE]}~{zlib.crc32(shape[SHAPE:].encode()) % SHAPE_RESTS}"
    return shape, letters, sum(c.isupper() for c in word), bool(_MARKED.search(word)), not any(c.isalnum() for c in word)


def variety(words: list[str], distinct: int) -> float:
    """Share of distinct words; from BLOCK words on the mean over all blocks."""
    n = len(words)
    if n <= BLOCK:
        return distinct / n
    starts = [*range(0, n - BLOCK, BLOCK), n - BLOCK]
    return sum(len(set(words[i:i + BLOCK])) for i in starts) / (BLOCK * len(starts))


def measures(text: str, memo: dict) -> tuple[dict[str, float], Counter]:
    words = text.split()
    n = len(words)
    if not n:
        return {}, Counter()
    counts = Counter(words)
    shapes: Counter = Counter()
    letters = capitals = marked = loose = size = 0
    for w, c in counts.items():
        facts = memo.get(w)
        if facts is None:
            if len(memo) >= MEMO_WORDS:
                memo.clear()
            facts = memo[w] = word_facts(w)
        shapes[facts[0]] += c
        letters += c * facts[1]
        capitals += c * facts[2]
        marked += c * facts[3]
        loose += c * facts[4]
        size += c * len(w)
    lines = [x for x in text.split("\n") if x.strip()]
    plain = sum(text.count(c) for c in ".,;:'\"-?")
    return {
        "symbols": max(0, size - letters - plain) / size, "variety": variety(words, len(counts)),
        "repeats": sum(a == b for a, b in zip(words, words[1:])) / n, "capitals": capitals / max(1, letters),
        "line_ends": sum(x.rstrip()[-1] in ".!?" for x in lines) / len(lines), "marked_words": marked / n,
        "top_word": max(counts.values()) / n, "word_length": size / n, "loose_symbols": loose / n,
        "words": n,
    }, shapes


def vote(m: dict[str, float]) -> str:
    """One character per heuristic: '+', '-' or '0' (no vote)."""
    if not m or m["words"] < LEAST_WORDS:
        return "0" * len(HEURISTICS)
    out = []
    for name, side, bad, good in HEURISTICS:
        x = m[name] if side == "above" else -m[name]
        b, g = (bad, good) if side == "above" else (-bad, -good)
        out.append("-" if x > b else "+" if x < g else "0")
    return "".join(out)


def features(m: dict[str, float], shapes: Counter) -> list[str]:
    if not m:
        return ["empty"]
    total = sum(shapes.values())
    out = [f"shape:{s}:{min(6, int(-np.log2(c / total)))}" for s, c in shapes.items()]
    out += [f"{k}:{min(20, int(v * 20))}" for k, v in m.items() if k not in ("words", "word_length")]
    return out + [f"length:{int(np.log2(m['words']))}", f"word_length:{min(20, int(2 * m['word_length']))}"]


def estimate(patterns: dict[str, int], rounds: int = EM_ROUNDS) -> tuple[float, np.ndarray, dict[str, float]]:
    """Share of good texts, accuracies[class, heuristic, vote] and the posterior of each pattern.

    Class 1 is the good one; votes are ordered -, +, and no vote is no evidence.  The start assumes that
    a heuristic is right in seven of ten votes, which also names the classes.
    """
    keys = sorted(patterns)
    count = np.array([patterns[k] for k in keys], float)
    hot = np.array([[(c == "-", c == "+") for c in k] for k in keys], float).reshape(len(keys), len(HEURISTICS), 2)
    share = np.einsum("p,phv->hv", count, hot) + 1
    share /= share.sum(1, keepdims=True)
    accuracy = np.stack([share * [1.4, 0.6], share * [0.6, 1.4]])
    accuracy /= accuracy.sum(2, keepdims=True)
    good = 0.8
    post = np.full(len(keys), good)
    for _ in range(rounds if len(keys) else 0):
        like = np.einsum("phv,chv->pc", hot, np.log(accuracy))
        post = sigmoid(np.log(good / (1 - good)) + like[:, 1] - like[:, 0])
        good = float(np.clip((count * post).sum() / count.sum(), 0.01, 0.99))
        for c, weight in enumerate((count * (1 - post), count * post)):
            accuracy[c] = np.einsum("p,phv->hv", weight, hot) + share  # one pseudo-vote, as the corpus votes
            accuracy[c] /= accuracy[c].sum(1, keepdims=True)
    return good, accuracy, dict(zip(keys, post.tolist()))


def _measured(batches):
    memo: dict = {}
    for ids, data in byte_batches(batches, RUN_BYTES):
        votes, own = [], []
        for text in data:
            m, shapes = measures(text.decode(), memo)
            votes.append(vote(m))
            own.append(sorted({feature(x) for x in features(m, shapes)}))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(votes), pa.array(own, pa.list_(pa.int64()))], ["doc_id", "votes", "features"])


def classify(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, votes, posterior, score, predicted of every row; score is the scorer's probability of good text.

    The texts are read once; their votes and features (a number for each shape and measure) are
    written to the shared folder, and all else is made from that table.
    """
    measured = written(texts(docs).mapInArrow(_measured, "doc_id long, votes string, features array<long>"))
    counts = measured.groupBy("votes").count().collect()  # at most 3^9 patterns
    _, _, posterior = estimate({r.votes: r["count"] for r in counts})
    sample = (measured.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("features")).limit(max_rows)
              .select("votes", "features").toArrow())
    rows = [np.asarray(x, np.int64) for x in sample.column("features").to_pylist()]
    target = np.array([posterior[v] for v in sample.column("votes").to_pylist()], float)
    vocabulary = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.int64)
    w, bias = fit(Rows(rows, vocabulary), target, 1e-4)
    sent = docs.sparkSession.sparkContext.broadcast((dict(zip(vocabulary.tolist(), w.tolist())), bias, posterior))

    def run(batches):
        weights, bias, posterior = sent.value
        for batch in batches:
            post = [posterior[v] for v in batch.column("votes").to_pylist()]
            score = [bias + sum(weights.get(h, 0.0) for h in own) for own in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("votes"), pa.array(post, pa.float64()), pa.array(sigmoid(score))],
                                             ["doc_id", "votes", "posterior", "score"])

    return (measured.mapInArrow(run, "doc_id long, votes string, posterior double, score double")
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))
