import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from geoprofile.llm import suffix_array as S
from geoprofile.llm import suffix_dedup as M

from .conftest import words


def brute(rows, length):
    """(id, bytes, removed, spans, sha256 of the rest) by counting every window of the corpus."""
    data = [(t or "").encode() for _, t in rows]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = Counter()
    for (doc_id, _), d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out[doc_id, len(d), int(gone.sum()), len(M.as_runs(gone)) // 2, hashlib.sha256(kept).hexdigest()] += 1
    return out


def got(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_suffix_array_and_common_prefixes():
    r = random.Random(2)
    for _ in range(30):
        strings = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 60))) for _ in range(r.randint(1, 6))]
        for length in (7, 9, 20):
            count = Counter(s[i:i + length] for s in strings for i in range(len(s) - length + 1))
            want = [[count[s[i:i + length]] > 1 for i in range(max(0, len(s) - length + 1))] for s in strings]
            assert [f.tolist() for f in S.repeated_windows(strings, length)] == want
    strings = [b"banana banana", b"", b"bandana banana", b"\0\0\0a\0", b"\0\0\0a\0\0", b"banana banana"]
    shard = S.Shard(strings)
    sa, rank = shard.sorted()
    suffixes = [(s[i:], n) for n, s in enumerate(strings) for i in range(len(s))]
    assert [suffixes[i] for i in sa] == sorted(suffixes) and rank[sa].tolist() == list(range(len(sa)))


def test_equal_windows_have_equal_anchors():
    r = random.Random(3)
    shared = r.randbytes(900)
    a, b = r.randbytes(333) + shared + r.randbytes(50), r.randbytes(77) + shared + r.randbytes(400)

    def windows(text):
        h, place, first, last = M.anchors(text)
        assert first[0] == 0 and last[-1] == len(text) - 400 and (first[1:] == last[:-1] + 1).all()
        return {s: (x, p - s) for x, p, f, l in zip(h.tolist(), place.tolist(), first.tolist(), last.tolist()) for s in range(f, l + 1)}

    x, y = windows(a), windows(b)
    assert all(x[333 + s] == y[77 + s] for s in range(501))


@pytest.mark.parametrize("shard", [2048, 3])  # tiny shards: most anchors are split and merged
def test_planted(spark, shard):
    r = random.Random(7)
    passage = words(50, 120)
    rows = []
    for i in range(60):
        w = words(100 + i, r.randint(5, 120)).split()
        if i % 3 == 0:
            w[r.randrange(len(w)):0] = passage.split()[r.randint(0, 9):]
        if i % 7 == 0:
            w += words(100 + (i * 5) % 60, 90).split()
        rows.append((i, " ".join(w)))
    rows += [(100, rows[4][1]), (101, "é" * 700), (102, "xyz" * 500), (103, None), (104, rows[9][1][1:])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(M.repeats(df, shard=shard)) == brute(rows, M.LENGTH)


def test_shorter_windows(spark):
    rows = [(i, words(i % 9, 30) + " " + words(70 + i, 20)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(M.repeats(df, length=60, gram=16, shard=2)) == brute(rows, 60)


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert got(M.op1_suffix_dedup(spark, small)) == brute(rows, M.LENGTH)


def test_edge_rows(edge_docs, edge_rows, no_docs, monkeypatch):
    want = brute([r[:2] for r in edge_rows], M.LENGTH)
    assert got(M.repeats(edge_docs)) == want
    monkeypatch.setattr(M, "RUN_BYTES", 5000)  # long texts in parts
    assert sum(1 for _ in M.anchors(words(2, 9000).encode())[0]) > 100
    assert M.repeats(no_docs).collect() == []
    left = M.strip_repeats(edge_docs)
    assert left.columns == edge_docs.columns and left.count() == len(edge_rows) and M.strip_repeats(no_docs).collect() == []
    texts = [r.text for r in left.collect()]
    assert sum(t is None for t in texts) == sum(r[1] is None for r in edge_rows)
    assert sum(len((t or "").encode()) for t in texts) == sum((k[1] - k[2]) * n for k, n in want.items())


def test_parts_of_long_texts(monkeypatch):
    text = words(2, 3000).encode()
    whole = {(h, p): 0 for h, p in zip(*(x.tolist() for x in M.anchors(text)[:2]))}
    monkeypatch.setattr(M, "RUN_BYTES", 1000)
    h, p, first, last = M.anchors(text)
    assert set(zip(h.tolist(), p.tolist())) == whole.keys() and (last - first + 1).sum() == len(text) - 399
