import numpy as np
from geoprofile.llm import quality as M

from .test_toxicity import auc


def test_against_given_labels(spark):
    d = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in M.op5_quality(spark, d).collect()}
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    rows = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{d}/labels.parquet").collect()]
    label = np.array([q for _, q in rows])
    assert auc(np.array([r.score for r, _ in rows]), label) > 0.95
    assert np.mean([r.predicted for r, q in rows if q == 1]) > 0.97


def test_expectation_maximisation_finds_accuracies():
    r = np.random.default_rng(0)
    truth = r.random(20_000) < 0.8
    right = np.linspace(0.6, 0.95, 9)
    votes = np.where(r.random((20_000, 9)) < right, truth[:, None], ~truth[:, None])
    silent = r.random((20_000, 9)) < 0.3
    keys, count = np.unique(["".join("0" if s else "+" if v else "-" for v, s in zip(a, b)) for a, b in zip(votes, silent)], return_counts=True)
    good, accuracy, _ = M.estimate(dict(zip(keys.tolist(), count.tolist())))
    assert abs(good - 0.8) < 0.02
    found = accuracy[1, :, 1]
    assert np.abs(found - right).max() < 0.03


def test_edge_rows(edge_docs, edge_rows, no_docs):
    got = M.classify(edge_docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in edge_rows)
    assert all(0 <= r.score <= 1 and len(r.votes) == 9 for r in got)
    assert len({(r.votes, r.posterior, r.score) for r in got if r.doc_id in (2, 3)}) == 1
    assert M.classify(no_docs).collect() == []
