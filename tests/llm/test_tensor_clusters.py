"""Pairs near the threshold in large groups are verified in blocks: they are no rows."""

import numpy as np
import pyarrow as pa
from geoprofile.llm import ngram_join
from geoprofile.llm import tensor_minhash as M

from .test_tensor_minhash import brute, corpus, frame, got


def test_pairs_of_a_hot_group_are_no_rows(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rows = corpus(5, 12, hot=150)
    sent, real = [], M.verified
    monkeypatch.setattr(M, "verified", lambda pairs, *rest: sent.append(pairs.count()) or real(pairs, *rest))
    assert got(M.near_classes(frame(spark, rows))) == brute(rows)
    assert len(sent) == 1 and sent[0] < len(rows)  # no more than a pair for each class


def test_connected_tells_the_same_components():
    r = np.random.default_rng(7)
    for n, m in ((2, 1), (50, 20), (50, 60), (300, 4000)):
        name = np.sort(r.choice(1 << 40, n, replace=False)) - (1 << 39)
        u, v = np.sort(name[np.stack([r.integers(0, n - 1, m), np.full(m, n - 1)])], 0) if m == 1 else np.sort(name[r.integers(0, n, (2, m))], 0)
        (batch,) = M._connected(lambda _: [pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])])(None)

        def parts(edges):
            forest = ngram_join.Forest()
            for a, b in edges:
                forest.join(a, b)
            return {x: forest.root(x) for x in name.tolist()}

        stars = list(zip(*batch.to_pydict().values()))
        assert parts(stars) == parts(zip(u.tolist(), v.tolist())) and len(stars) < n
