"""Language-model scoring of complete documents (operator 2).

Tokens are the lower-cased (A-Z) words of a text and one end token.  Counts over all
training documents give the base model, every word with (c+0.1)/(N+0.1(V+1)).  A
gated recurrent network (``gru.py``) predicts the most frequent tokens, or that the next
word is another one; such a word then has its share of the base model's mass of
other words:

    p(text) = product of p(token | state)                      for its vocabulary
              and of p(other | state) * base(word) / base(other)  for the rest,

which is a distribution over the same words as the base model.  The state runs
through the complete document: windows bound only the memory.

Texts are read twice: for the counts of all words (shuffled by word, partial sums first), and to
write each document as network tokens, sums over its frequent words, whose counts are sent to the tasks
(at most 1/HOT_SHARE words can have that share of all tokens), and a list of its remaining words.  The network
learns and scores from these tokens; the remaining words are joined with their counts, by word.  Since frequent
words are no part of the join, no key of it can be hot.

The network learns from all training documents, each of them whole.  A pass over them is cut into
rounds (ROUNDS at most) by a hash, and a round into parts of about PART_TOKENS tokens.  Each part
goes on from the round's weights by truncated backpropagation in a task of its own, which holds at most
RUN_TOKENS tokens or one document; then the parts' weights are averaged by their tokens, FAN of them at a
time in tasks, so the driver gets at most FAN.  A corpus of under PASS_TOKENS tokens is passed up to PASSES times.
The same rows give the same network, however they are partitioned.

Edge cases: a null or empty text is the end token alone; a null id counts as held
out; repeated rows are scored each; an empty table gives no rows; without training
tokens every word has the base probability 1 of the unseen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_batches, sliced, table, texts, written
from .gru import Gru
from .picking import text_hashes
from .word_hashes import word_hashes

CLASSES, CLASS_SIZE, HIDDEN = 32, 32, 16
HOT_SHARE = 1 / 200_000
ROUNDS, PART_TOKENS, RUN_TOKENS = 8, 1 << 20, 1 << 21
PASSES, PASS_TOKENS = 4, 1 << 22
LANES, STEP_TOKENS = 128, 4096
FAN = 64
RUN_BYTES, RUN_CODES = 24 << 20, 4 << 20
END, END_HASH = b" ", -1  # no word holds white space
LN10 = np.log(10)


def word_hash(word: bytes) -> int:
    return int(word_hashes([word])[0].view(np.int64)[0]) if word != END else END_HASH


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(True))


def hashed(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts in turn, words per text); END closes each text."""
    word, ends = word_hashes([text.lower() for text in data])
    return np.insert(word.view(np.int64), ends, END_HASH), np.diff(ends, prepend=0) + 1


def numbered(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each distinct word, words of all texts as numbers of these, words per text); END closes each text."""
    flat, sizes = hashed(data)
    return *np.unique(flat, return_inverse=True), sizes


def _count(batches):
    for _, data in byte_batches(batches, RUN_BYTES):
        words, n = np.unique(hashed(data)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n)], ["word", "c"])


def word_counts(docs: DataFrame) -> DataFrame:
    """word (64-bit hash) and c, its count in the training documents."""
    training = texts(docs).filter(~held_out(F.col("doc_id"))).select("doc_id", "text")
    return training.mapInArrow(_count, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Frequent:
    """The frequent words' counts, the corpus totals and the network's vocabulary."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.total, self.distinct = total, distinct
        self.norm = total + 0.1 * (distinct + 1)
        best = np.lexsort((self.words, -self.counts))[:CLASSES * CLASS_SIZE - 1]
        self.token = np.zeros(len(self.words), np.int64)  # 0 stands for other words
        self.token[best] = np.arange(1, len(best) + 1)
        shares = np.zeros(CLASSES * CLASS_SIZE)
        shares[1:len(best) + 1] = (self.counts[best] + 0.1) / self.norm
        shares[0] = max(1e-12, 1 - shares.sum())
        self.shares = shares

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the frequent words or -1, network token) of each word."""
        if not len(self.words):
            return np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        at = np.where(self.words[at] == hashes, at, -1)
        return at, np.where(at >= 0, self.token[at], 0)


def _sum_by_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(sizes) - sizes)


def _train(sent, span: tuple[float, float]):
    """Rows sorted by part -> part, n (its tokens) and the weights after them, as bytes."""
    def learn(network: Gru, held: list[np.ndarray]) -> None:
        width = min(LANES, max(1, sum(map(len, held)) // max(map(len, held))))  # few lanes for a long document: bounded memory
        network.train(held, 1, width, max(1, STEP_TOKENS // width), span=span)

    def row(part: int, n: int, network: Gru):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([network.weights().tobytes()], pa.binary())], ["part", "n", "weights"])

    def run(batches):
        now, network, held, size, n = None, None, [], 0, 0
        for batch in batches:
            for part, tokens in zip(batch.column("part").to_pylist(), batch.column("tokens").to_pylist()):
                tokens = np.frombuffer(tokens, np.int16).astype(np.int32)
                if held and (part != now or size + len(tokens) > RUN_TOKENS):
                    learn(network, held)
                    held, size = [], 0
                if part != now:
                    if network:
                        yield row(now, n, network)
                    now, network, n = part, Gru(CLASSES, CLASS_SIZE, HIDDEN), 0
                    network.set_weights(sent.value)
                held.append(tokens)
                size, n = size + len(tokens), n + len(tokens)
        if held:
            learn(network, held)
            yield row(now, n, network)
    return run


def _mean(rows) -> tuple[int, np.ndarray | None]:
    """Tokens and mean weights of (n, weights) rows."""
    total, out = 0, None
    for n, weights in rows:
        own = np.frombuffer(weights, np.float32).astype(float) * n
        out, total = own if out is None else out + own, total + n
    return total, out if out is None else (out / total).astype(np.float32)


def _averaged(batches):
    """Rows sorted by part, which is now that of the next level -> one row for each."""
    held, now = [], None
    for batch in batches:
        for part, n, weights in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "weights"))):
            if held and part != now:
                total, mean = _mean(held)
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([total], pa.int64()), pa.array([mean.tobytes()], pa.binary())], ["part", "n", "weights"])
                held = []
            now = part
            held.append((n, weights))
    if held:
        total, mean = _mean(held)
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([total], pa.int64()), pa.array([mean.tobytes()], pa.binary())], ["part", "n", "weights"])


ENCODED = ("doc_id long, text_hash long, n_tokens long, n_known long, base double, other double, tokens binary, "
           "rare_words array<long>, rare_n array<int>")


def encoded(docs: DataFrame, frequent: Frequent) -> DataFrame:
    """Every row as network tokens (int16), with sums over its frequent words and its remaining words with their counts, written.

    n_known and base: the frequent words' part of them; other: what they add to the network's score where it sees "other".
    """
    known = docs.sparkSession.sparkContext.broadcast(frequent)  # bounded by 1 / HOT_SHARE

    def encode(batches):
        frequent = known.value
        base = np.log10((frequent.counts + 0.1) / frequent.norm)
        for ids, data in byte_batches(batches, RUN_BYTES):
            hashes, flat, sizes = numbered(data)
            at, token = frequent.find(hashes)
            own = np.where(at >= 0, base[at] if len(base) else 0.0, 0.0)  # the rest is added by the join
            other = np.where(token == 0, own - np.log10(frequent.shares[0]), 0.0)
            codes, ends = token.astype(np.int16)[flat], np.cumsum(sizes)
            rare = (at < 0)[flat]
            key, n = np.unique((np.repeat(np.arange(len(data)), sizes) * len(hashes) + flat)[rare], return_counts=True)
            offsets = pa.array(np.searchsorted(key, np.arange(len(data) + 1) * len(hashes)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(text_hashes(data)), pa.array(sizes), pa.array(sizes - _sum_by_text(rare.astype(np.int64), sizes)),
                 pa.array(_sum_by_text(own[flat], sizes)), pa.array(_sum_by_text(other[flat], sizes)),
                 pa.array([codes[e - n:e].tobytes() for e, n in zip(ends, sizes)], pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(hashes[key % len(hashes)])), pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32)))],
                ["doc_id", "text_hash", "n_tokens", "n_known", "base", "other", "tokens", "rare_words", "rare_n"])

    return written(texts(docs).mapInArrow(encode, ENCODED))


def fit_network(docs: DataFrame, frequent: Frequent) -> tuple[Gru, int]:
    """The network, trained on all training documents, and the number of tokens it has learnt from, all passes together."""
    return train_network(encoded(docs, frequent), frequent)


def train_network(rows: DataFrame, frequent: Frequent) -> tuple[Gru, int]:
    """As ``fit_network``, from encoded rows."""
    context = rows.sparkSession.sparkContext
    network = Gru(CLASSES, CLASS_SIZE, HIDDEN)
    network.start_from(frequent.shares)
    if not frequent.total:
        return network, 0
    passes = int(np.clip(-(-PASS_TOKENS // frequent.total), 1, PASSES))
    rounds = int(np.clip(frequent.total // PART_TOKENS, 1, ROUNDS))
    parts = int(-(-frequent.total // (rounds * PART_TOKENS)))
    slot = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(rounds * parts))
    rows = (rows.filter(~held_out(F.col("doc_id"))).select("doc_id", "text_hash", "tokens")
            .withColumns({"round": F.floor(slot / parts).cast("int"), "part": F.pmod(slot, F.lit(parts))}))
    schema, learnt = "part long, n long, weights binary", 0
    for k in range(passes * rounds):
        sent = context.broadcast(network.weights())
        span = k / (passes * rounds), (k + 1) / (passes * rounds)
        found = (rows.filter(F.col("round") == k % rounds).select("part", "doc_id", "text_hash", "tokens").repartition(parts, "part")
                 .sortWithinPartitions("part", "doc_id", "text_hash").mapInArrow(_train(sent, span), schema))
        left = parts
        while left > FAN:
            left = -(-left // FAN)
            found = (found.withColumn("next", F.pmod("part", F.lit(left))).repartition(left, "next").sortWithinPartitions("next", "part")
                     .select(F.col("next").alias("part"), "n", "weights").mapInArrow(_averaged, schema))
        n, mean = _mean([(r.n, r.weights) for r in sorted(found.collect(), key=lambda r: r.part)])  # at most FAN rows
        if mean is not None:
            network.set_weights(mean)
        learnt += n
        sent.unpersist()
    return network, learnt


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    counts = written(word_counts(docs))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    hot = F.col("c") >= F.lit(total * HOT_SHARE)
    found = counts.filter(hot).toArrow()  # at most 1 / HOT_SHARE words
    frequent = Frequent(found.column("word").to_numpy(), found.column("c").to_numpy(), total, distinct)
    rows = encoded(docs, frequent)
    network, _ = train_network(rows, frequent)
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def score(batches):
        for batch in sliced(batches, RUN_CODES, "tokens"):
            steps = [np.frombuffer(t, np.int16).astype(np.int32) for t in batch.column("tokens").to_pylist()]
            logp = pa.array(sent.value.score(steps) / LN10 + batch.column("other").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "text_hash", "n_tokens", "n_known", "base", "n_rare")), logp],
                                             ["doc_id", "text_hash", "n_tokens", "n_known", "base", "n_rare", "logp"])

    docs_scored = (rows.select("doc_id", "text_hash", "n_tokens", "n_known", "base", F.size("rare_words").alias("n_rare"), "other", "tokens")
                   .mapInArrow(score, "doc_id long, text_hash long, n_tokens long, n_known long, base double, n_rare int, logp double"))
    rare = (rows.select("doc_id", "text_hash", F.inline(F.arrays_zip("rare_words", "rare_n"))).toDF("doc_id", "text_hash", "word", "n")
            .join(counts.filter(~hot), "word", "left")
            .groupBy("doc_id", "text_hash")
            .agg(F.sum(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 0.1) / F.lit(frequent.norm))).alias("rare_base"),
                 F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
                 F.count("*").alias("rare_rows"))
            .select(F.col("doc_id").alias("rare_id"), F.col("text_hash").alias("rare_hash"), "rare_base", "rare_known", "rare_rows"))
    copies = F.col("rare_rows") / F.col("n_rare")  # of a row that is repeated, whose words were summed so often
    extra = F.coalesce(F.col("rare_base") / copies, F.lit(0.0))
    return (docs_scored.join(rare, (F.col("text_hash") == F.col("rare_hash")) & F.col("doc_id").eqNullSafe(F.col("rare_id")), "left")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
                    (F.col("n_known") + F.coalesce((F.col("rare_known") / copies).cast("long"), F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base") + extra).alias("base_score"), (F.col("logp") + extra).alias("score")))


def op2_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
