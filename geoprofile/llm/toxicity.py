"""Counterfactual-regularised toxicity classifier (operator 4).

Features are hashed: the distinct lower-case words of a text and their first
four and five letters, so that inflected forms share evidence.  Features whose
presence differs clearly between the labels enter a logistic regression.
Each sentence of a labelled text that names a group is copied with the identity
terms swapped for every other of their sets, and the squared change of the score is penalised, so that a
group's mention alone does not raise a score.

Many corpora name no group in what is labelled.  So every labelled text also gives a carrier: the text, with its
label, in which one more sentence mentions a term of one set (set and term by the hash of the text's features).  Carriers are
rows of the fit, and the carrier of each term of the set is paired with that of the next one, and the first with the text itself:
a neutral mention should change nothing.  What a pair has in common cancels in its score change, so
only the terms that differ are kept of it.

The classifier is fitted on at most ``max_rows`` labelled rows (a
documented parameter; rows are taken by the hash of their id, held-out rows
never), and has at most MAX_FEATURES features beside the identity terms.  Scoring reads every whole text in one narrow pass.

Edge cases: a null or empty text has no features and gets the bias alone; a
null id is held out; repeated label rows count as often as they stand; with no usable
label the score is that of a prior of 0.25.  No rows give no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_batches, in_arrow, sliced, table, texts
from .linear import Rows, feature, fit, sigmoid

MAX_ROWS = 12_000
RUN_BYTES = 16 << 20
MEMO_WORDS = 300_000
MAX_FEATURES = 20_000
PAIR_WEIGHT, CARRIER_WEIGHT = 5.0, 5.0

# Identity terms, in sets whose members are swapped for one another.
IDENTITY_SETS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indian"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"), ("immigrants", "refugees", "natives", "foreigners"),
    ("disabled", "blind", "deaf", "autistic"), ("elderly", "old", "young"),
    ("femmes", "hommes", "filles", "garçons"), ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer", "mädchen", "jungen"), ("muslime", "christen", "juden"),
    ("mujeres", "hombres", "niñas", "niños"), ("musulmanes", "cristianos", "judíos"),
)
_SWAP = {t: s for s in IDENTITY_SETS for t in s}
_WORD, _SENTENCE = re.compile(r"[^\W\d_]+"), re.compile(r"[.!?;\n]+")


def names(word: str) -> list[str]:
    """Feature names of one word."""
    if word in _SWAP:
        return [word]
    return [word] + [f"{k}:{word[:k]}" for k in (4, 5) if len(word) > k]


def hashed(words: set[str]) -> np.ndarray:
    return np.unique(np.fromiter((feature(x) for w in words for x in names(w)), np.int64))


def counterfactuals(words: set[str]) -> list[set[str]]:
    """The words with every identity term replaced by the 1st, 2nd, .. next of its set, until each set has come round."""
    terms = [w for w in words if w in _SWAP]
    out = []
    for k in range(1, max((len(_SWAP[w]) for w in terms), default=0)):
        new = {_SWAP[w][(_SWAP[w].index(w) + k) % len(_SWAP[w])] if w in _SWAP else w for w in words}
        if new != words and new not in out:
            out.append(new)
    return out


def sentence_pairs(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each sentence and its counterfactuals the features that only one of the two has; each such pair once."""
    found = {}
    for sentence in _SENTENCE.split(text):
        words = set(_WORD.findall(sentence))
        own = None
        for other in counterfactuals(words):
            own = hashed(words) if own is None else own
            new = hashed(other)
            pair = np.setdiff1d(own, new), np.setdiff1d(new, own)
            found.setdefault((pair[0].tobytes(), pair[1].tobytes()), pair)
    return list(found.values())


def mention(x: np.ndarray) -> tuple[int, list[tuple[np.ndarray, np.ndarray]]]:
    """The identity term (its feature) that the carrier of a text with features ``x`` mentions, and the pairs of such carriers."""
    pick = feature(x.astype(np.int64).tobytes()) & (1 << 62) - 1
    terms = [feature(t) for t in IDENTITY_SETS[pick % len(IDENTITY_SETS)]]
    one = lambda *t: np.array([f for f in t if f not in held], np.int64)
    held = set(x[np.isin(x, terms)].tolist())  # a second mention changes nothing
    pairs = [(one(), one(terms[0])), *((one(a), one(b)) for a, b in zip(terms, terms[1:]))]
    return terms[pick // len(IDENTITY_SETS) % len(terms)], [(a, b) for a, b in pairs if len(a) + len(b)]


@dataclass
class Model:
    weights: dict[int, float]
    bias: float


def choose(rows: list[np.ndarray], label: np.ndarray, most: int = MAX_FEATURES, least_rows: int = 3, least_z: float = 3.0) -> np.ndarray:
    """Features whose share of positive rows differs from the overall share by ``least_z`` standard errors, largest first."""
    if not rows:
        return np.zeros(0, np.int64)
    col, of = np.unique(np.concatenate(rows), return_inverse=True)
    y = np.repeat(label, [len(r) for r in rows])
    n, pos = np.bincount(of, minlength=len(col)), np.bincount(of, y, minlength=len(col))
    p = min(max(label.mean(), 1e-6), 1 - 1e-6)
    z = np.abs(pos - n * p) / np.sqrt(n * p * (1 - p))
    z[(n < least_rows) | (z < least_z)] = 0
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(col[best[z[best] > 0]])


def fit_model(rows: list[np.ndarray], label: np.ndarray, swapped: list[tuple[np.ndarray, np.ndarray]],
              pair_weight: float = PAIR_WEIGHT, l2: float = 1e-4, carrier_weight: float = CARRIER_WEIGHT) -> Model:
    """``swapped``: (features of a text or sentence, features of its copy with other identity terms); carriers are made of
    ``rows``, their pairs count ``carrier_weight``, and with 0 there are none."""
    vocabulary = choose(rows, label)
    terms = np.array(sorted(feature(t) for t in _SWAP))
    carriers = [mention(x) for x in rows] if carrier_weight else []
    if carriers:
        vocabulary = np.union1d(vocabulary, terms)
    elif swapped:
        vocabulary = np.union1d(vocabulary, np.intersect1d(terms, np.concatenate([x for pair in swapped for x in pair])))
    kept = [np.intersect1d(x, vocabulary, assume_unique=True) for x in rows]
    if carriers:
        kept += [np.union1d(x, [t]) for x, (t, _) in zip(kept, carriers)]
        label = np.concatenate((label, label))
    pairs = []
    for found, weight in ((swapped, pair_weight), ([p for _, own in carriers for p in own], carrier_weight)):
        if found:
            pairs.append((Rows([a for a, _ in found], vocabulary), Rows([b for _, b in found], vocabulary), weight))
    w, b = fit(Rows(kept, vocabulary), label, l2, pairs)
    return Model(dict(zip(vocabulary.tolist(), w.tolist())), b)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def _features(batches):
    for ids, data in byte_batches(batches, RUN_BYTES):
        own, pairs = [], []
        for text in data:
            text = text.decode().lower()
            own.append(hashed(set(_WORD.findall(text))))
            pairs.append([x for pair in sentence_pairs(text) for x in pair])  # two lists for each pair
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(own, pa.list_(pa.int64())),
                                          pa.array(pairs, pa.list_(pa.list_(pa.int64())))], ["doc_id", "features", "swapped"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on the labelled rows that are not held out, at most ``max_rows`` of them."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("toxic"))
              .filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_rows))
    label = {}
    for r in chosen.collect():  # at most max_rows pairs of numbers
        label.setdefault(r.doc_id, []).append(r.toxic)
    spark = docs.sparkSession
    ids = spark.createDataFrame(pa.table({"doc_id": pa.array(list(label), pa.int64())}))  # no Python worker reads it
    sample = texts(docs).join(F.broadcast(ids), "doc_id", "left_semi")  # at most max_rows ids
    own, y, swapped = [], [], []
    found = sample.transform(in_arrow, _features, "doc_id long, features array<long>, swapped array<array<long>>").toArrow()
    for doc_id, x, pairs in zip(*(found.column(c) for c in ("doc_id", "features", "swapped"))):
        x = np.asarray(x.values.to_numpy(zero_copy_only=False) if x.values is not None else [], np.int64)
        for t in label[doc_id.as_py()]:
            own.append(x)
            y.append(t)
        sides = [np.asarray(p, np.int64) for p in pairs.as_py()]
        swapped += zip(sides[::2], sides[1::2])
    return fit_model(own, np.array(y, float), swapped)


class Scorer:
    """Scores of texts under a model; remembers the weighted features of words it has met."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def __call__(self, data: list[bytes]) -> np.ndarray:
        weights, memo, out = self.model.weights, self.memo, []
        for text in data:
            hits = set()
            for w in set(_WORD.findall(text.decode().lower())):
                got = memo.get(w)
                if got is None:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    got = memo[w] = tuple(h for h in map(feature, names(w)) if h in weights)
                if got:
                    hits.update(got)
            out.append(self.model.bias + sum(weights[h] for h in sorted(hits)))
        return sigmoid(out)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_FEATURES and the identity terms

    def run(batches):
        scorer = Scorer(sent.value)
        for ids, data in byte_batches(batches, RUN_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(scorer(data))], ["doc_id", "score"])

    return texts(docs).transform(in_arrow, run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    return (score(docs, train(docs, labels, max_rows))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they were; one narrow pass."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches):
        scorer = Scorer(sent.value)
        for batch in sliced(batches, RUN_BYTES):
            data = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            yield batch.filter(pa.array(scorer(data) < 0.5))

    return docs.transform(in_arrow, run, docs.schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
