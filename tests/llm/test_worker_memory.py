"""What executors hold beside the JVM: idle workers stay for later stages, so their number and what they keep count."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from geoprofile.llm import ngram_join as near
from geoprofile.llm import packing, suffix_dedup, toxicity

from .conftest import words


def test_counts_hold_a_run_once(monkeypatch):
    """Tokens of a run are counted range by range: no second copy of all of them is made."""
    r = random.Random(4)
    data = [" ".join(f"w{r.randrange(400)}" for _ in range(300)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(data)], ["doc_id", "text"])
    sets = near.shingle_sets([t.encode() for t in data], 1)
    made, join = [], np.concatenate

    def told(parts, *rest):
        made.append(sum(map(len, parts)))
        return join(parts, *rest)

    monkeypatch.setattr(near, "shingle_sets", lambda *_: sets)
    monkeypatch.setattr(near.np, "concatenate", told)
    got = pa.Table.from_batches(list(near._counts(1)([batch]))).to_pydict()
    monkeypatch.undo()
    want = {t: n for t, n in Counter(int(t) for s in sets for t in s.view(np.int64)).items() if n > 1}
    assert dict(zip(got["token"], got["n"])) == want and len(got["token"]) == len(want)
    assert max(made) < sum(map(len, sets)) / 8


def test_cut_does_not_chain_two_workers(spark, tmp_path):
    """The few rows to cut are exchanged before: a task with two Python steps holds two workers, which stay with the executor."""
    docs = spark.createDataFrame([(i, words(1, 80) if i < 2 else words(i, 80), "x", "y", 3) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "docs"))
    plan = suffix_dedup.strip_passages(spark.read.parquet(str(tmp_path / "docs")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 3 and "Exchange" in plan and "BroadcastHashJoin" not in plan


def test_sample_ids_need_no_worker(spark, small, monkeypatch):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    docs = spark.read.parquet(f"{small}/documents.parquet")

    def never(*_, **__):
        raise AssertionError("a list through a Python worker")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", never)
    assert toxicity.train(docs, labels).weights


def test_cache_keeps_the_words_that_come_often(monkeypatch):
    """Beyond CACHE_WORDS the common words stay, with the same ids as without a limit."""
    often = [f"often{k}," for k in range(20)]
    data = [" ".join([*often, *(f"once{n}x{k}" for k in range(40)), *often]).encode() for n in range(12)]
    free = packing.WordTokens(packing.tokenizer_spec())
    want = [free.encode([t]) for t in data]
    monkeypatch.setattr(packing, "CACHE_WORDS", 100)
    tight = packing.WordTokens(packing.tokenizer_spec())
    asked, tokenize = [], tight._joined
    monkeypatch.setattr(tight, "_joined", lambda words, letters: asked.extend(words) or tokenize(words, letters))
    for t, (ids, ends) in zip(data, want):
        got = tight.encode([t])
        assert (got[0] == ids).all() and (got[1] == ends).all()
        assert len(tight.number) < 300
    assert len(free.number) > 480 and sum(w.startswith(b"often") for w in asked) <= 20
