import random

import numpy as np
from geoprofile.llm import lm as M

from .conftest import words


def frequent(docs):
    counts = M.word_counts(docs).collect()
    return M.Frequent(np.array([r.word for r in counts]), np.array([r.c for r in counts]), sum(r.c for r in counts), len(counts))


def test_learns_from_every_token_of_every_text(spark, monkeypatch):
    monkeypatch.setattr(M, "PASSES", 1)
    rows = [(i, words(i, 20)) for i in range(3300)] + [(9001, words(1, 3000)), (9002, words(2, 700))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    f = frequent(docs)
    for part_tokens in (1 << 20, 2000):  # one part; many parts and levels
        monkeypatch.setattr(M, "PART_TOKENS", part_tokens)
        monkeypatch.setattr(M, "FAN", 2)
        monkeypatch.setattr(M, "RUN_TOKENS", 1500)
        assert M.fit_network(docs, f)[1] == f.total


def test_partitions_do_not_matter_and_rounds_learn(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_TOKENS", 8000)
    r = random.Random(4)
    rows = []
    for i in range(300):  # each word names the next, but for a third of them
        w, out = r.randrange(40), []
        for _ in range(r.randint(20, 400)):
            w = (w * 7 + 3) % 41 if r.random() < 0.67 else r.randrange(41)
            out.append(f"w{w}")
        rows.append((i, " ".join(out)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    f = frequent(docs)
    one, five = (M.fit_network(docs.repartition(n), f)[0].weights() for n in (1, 5))
    assert (one == five).all()
    held = [x for x in M.score_documents(docs).collect() if x.held_out]
    assert len(held) > 10 and all(x.score > x.base_score for x in held)
