import math
import zlib
from collections import Counter

import numpy as np
import pytest
from geoprofile.llm import lm as M
from geoprofile.llm.gru import Gru


def base_scores(rows):
    out = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    tokens = [[*(text or "").encode().lower().split(), None] for _, text in rows]
    c = Counter(t for (i, _), x in zip(rows, tokens) if not out(i) for t in x)
    total, distinct = sum(c.values()), len(c)
    norm = total + 0.1 * (distinct + 1)
    return [(i, out(i), len(x), sum(c[t] > 0 for t in x), total, round(sum(math.log10((c[t] + 0.1) / norm) for t in x), 5)) for (i, _), x in zip(rows, tokens)]


def compare(got, rows):
    key = lambda r: tuple(str(x) for x in r)
    mine = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=key)
    for a, b in zip(mine, sorted(base_scores(rows), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-6)


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    compare(M.op2_lm_scoring(spark, small).collect(), rows)


def test_beats_the_base_model_on_held_out_texts(spark):
    got = [r for r in M.op2_lm_scoring(spark, "/root/testdata/sf0.1").collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got) * 0.97
    assert np.mean([r.score > r.base_score for r in got]) > 0.9


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    got = M.score_documents(edge_docs).collect()
    compare(got, [r[:2] for r in edge_rows])
    assert all(r.score < 0 for r in got)
    assert M.score_documents(no_docs).collect() == []
    lone = M.score_documents(edge_docs.filter("doc_id is null")).collect()  # no training tokens
    assert all(r.base_score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in lone) and len(lone) == 3


def tiny(seed=0):
    g = Gru(3, 4, 5, seed)
    r = np.random.default_rng(seed)
    g.p = {k: r.standard_normal(v.shape) * 0.5 for k, v in g.p.items()}
    return g, r


def test_probabilities_sum_to_one_and_windows_carry_the_state():
    g, r = tiny()
    text = r.integers(0, 12, 150)
    every = g.score([np.append(text, t) for t in range(12)])
    assert np.exp(every - g.score([text])[0]).sum() == pytest.approx(1, abs=1e-4)
    docs = [text, text[:3], text[5:90], text[:1]]
    one = np.concatenate([g.score([d]) for d in docs])
    for width in (1, 2, 4):
        assert g.score(docs, width) == pytest.approx(one, rel=1e-4)


def test_gradients():
    g, r = tiny(1)
    token, target = r.integers(0, 13, (6, 2)), r.integers(0, 12, (6, 2))
    token[3, 0] = 12
    used = np.ones((6, 2), bool)
    used[5, 1] = False
    h = r.standard_normal((2, 5)) * 0.1
    _, grads, _ = g.gradients(token, target, used, h)
    for name, value in g.p.items():
        for at in list(np.ndindex(value.shape))[:: max(1, value.size // 12)]:
            old = value[at]
            value[at] = old + 1e-5
            up = g.gradients(token, target, used, h)[0]
            value[at] = old - 1e-5
            down = g.gradients(token, target, used, h)[0]
            value[at] = old
            assert (up - down) / 2e-5 == pytest.approx(grads[name][at], abs=1e-6)


def test_score_against_a_plain_forward_pass_of_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(M, "HOT_SHARE", 1 / 400)  # most words are joined
    rows = [(i, " ".join(f"w{(i * 7 + k * k) % (5 + i)}" for k in range(3 + 9 * i % 200))) for i in range(60)] + [(100, "w1 never seen"), (101, None)]
    rows += [(7, rows[7][1]), (5, "w1 w1 w2 w400")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = []
    fit = M.train_network
    monkeypatch.setattr(M, "train_network", lambda r, f: kept.append((f, fit(r, f))) or kept[-1][1])
    got = M.score_documents(docs).collect()
    f, (net, _) = kept[0]
    p = {k: v.astype(float) for k, v in net.p.items()}
    token = dict(zip(f.words.tolist(), f.token.tolist()))
    out = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not out(i) for w in [*(t or "").encode().split(), b" "])

    def soft(x):
        return x - np.log(np.exp(x).sum())

    def plain(text):
        h, last, total = np.zeros(M.HIDDEN), M.CLASSES * M.CLASS_SIZE, 0.0
        for w in [*(text or "").encode().split(), b" "]:
            t, n = token.get(M.word_hash(w), 0), M.HIDDEN
            x, u = p["table"][last], h @ p["u"]
            z, r = (1 / (1 + np.exp(-(x[k:k + n] + u[k:k + n]))) for k in (0, n))
            new = np.tanh(x[2 * n:] + r * u[2 * n:])
            h = z * h + (1 - z) * new
            k, j = divmod(t, M.CLASS_SIZE)
            total += (soft(h @ p["cw"] + p["cb"])[k] + soft(h @ p["ww"][k] + p["wb"][k])[j]) / math.log(10)
            if not t:
                total += math.log10((c[w] + 0.1) / f.norm) - math.log10(f.shares[0])
            last = t
        return total

    find = {}
    for r in got:
        find.setdefault(r.doc_id, []).append(r.score)
    want = {}
    for i, text in rows:
        want.setdefault(i, []).append(plain(text))
    assert set(find) == set(want)
    for i in want:
        assert sorted(find[i]) == pytest.approx(sorted(want[i]), rel=1e-4)
