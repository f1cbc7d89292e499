import random
import zlib

import numpy as np
from geoprofile.llm import toxicity as M


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    pos = label == 1
    return (rank[pos].mean() - (pos.sum() - 1) / 2) / (~pos).sum()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in M.op4_toxicity(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for i, r in got.items())
    rows = [(got[r.doc_id], r.toxic) for r in spark.read.parquet(f"{d}/labels.parquet").collect() if got[r.doc_id].held_out]
    label = np.array([t for _, t in rows])
    assert auc(np.array([r.score for r, _ in rows]), label) > 0.97
    assert np.mean([r.predicted == t for r, t in rows]) > 0.97
    assert np.mean([r.predicted for r, t in rows if t == 0]) < 0.01


def test_swapped_identity_terms_score_alike():
    r = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows, label, swapped = [], [], []
    for _ in range(800):
        words = set(r.sample(base, 12))
        toxic = r.random() < 0.3
        if toxic and r.random() < 0.7:
            words.add("awful")
        if r.random() < (0.6 if toxic else 0.1):  # attacks name one group more often than neutral texts do
            words.add("muslims")
        rows.append(M.hashed(words))
        label.append(toxic)
        swapped += [(rows[-1], M.hashed(c)) for c in M.counterfactuals(words)]
    label = np.array(label, float)
    neutral, other = M.hashed({"w1", "w2", "muslims"}), M.hashed({"w1", "w2", "christians"})

    def gap(weight):
        model = M.fit_model(rows, label, swapped, pair_weight=weight, carrier_weight=0)
        score = lambda x: M.sigmoid(model.bias + sum(model.weights.get(h, 0.0) for h in x.tolist()))
        return abs(score(neutral) - score(other)), score(neutral), score(M.hashed({"awful"}))

    plain, regular = gap(0.0), gap(50.0)
    assert regular[0] < 0.2 * plain[0] and regular[1] < plain[1] and regular[2] > 0.5


def test_sentences_are_swapped_for_every_other_term():
    found = M.sentence_pairs("the jews came. nobody else did!\nold men and jews; the jews came")
    f = lambda *t: tuple(sorted(M.feature(x) for x in t))
    got = {(tuple(a.tolist()), tuple(b.tolist())) for a, b in found}
    alone = {(f("jews"), f(t)) for t in M._SWAP["jews"] if t != "jews"}
    assert alone <= got and len(alone) == 6 and len(found) == len(got)
    assert (f("old", "men", "jews"), f("young", "boys", "hindus")) not in got  # all terms move by the same number of places
    assert (f("old", "men", "jews"), f("young", "girls", "hindus")) in got
    assert M.sentence_pairs("nobody is named here. nor here") == []


def test_every_labelled_text_has_a_carrier_and_a_fit_without_differs(spark, monkeypatch):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    seen = []
    monkeypatch.setattr(M, "fit_model", lambda rows, label, swapped: seen.append((rows, label, swapped)))
    M.train(docs, labels)
    monkeypatch.undo()
    rows, label, swapped = seen[0]
    pairs = [M.mention(x)[1] for x in rows]
    assert len(rows) > 1000 and min(map(len, pairs)) >= 2
    assert {f for own in pairs for a, b in own for f in [*a.tolist(), *b.tolist()]} == {M.feature(t) for t in M._SWAP}
    terms = [[M.feature(t) for t in s] for s in M.IDENTITY_SETS]
    spread = lambda m: max(np.ptp([m.weights.get(t, 0.0) for t in s]) for s in terms)
    with_pairs, rows_alone = M.fit_model(rows, label, swapped), M.fit_model(rows, label, swapped, carrier_weight=1e-9)
    assert M.fit_model(rows, label, swapped, carrier_weight=0).weights != with_pairs.weights
    assert 0 < spread(with_pairs) < 0.2 * spread(rows_alone)
    size = lambda m: max(abs(m.weights.get(t, 0.0)) for s in terms for t in s)
    assert size(with_pairs) < 0.5 * size(rows_alone)  # a neutral mention changes little


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(19)] + [(3, 1, "x"), (None, 1, None), (4, None, None), (999, 1, "y")], "doc_id long, toxic int, text string")
    got = M.classify(edge_docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in edge_rows)
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    none = M.classify(edge_docs, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {0}
    assert M.classify(no_docs, labels).collect() == []
    kept = M.drop_toxic(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r.predicted == 0 for r in got)
    assert M.drop_toxic(no_docs, labels).collect() == []
