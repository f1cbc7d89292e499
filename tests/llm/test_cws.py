import hashlib
from collections import Counter

import numpy as np
import pytest
from geoprofile.llm import cws as M
from pyspark.sql import functions as F


def edited_texts(rows):
    """(id, text, edited, next) by brute force; rows of one id need a given order, so ids are distinct here."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)]
        k = len(text) // 3
        out.append((doc_id, text, text[:len(text) - k] + after[1][:k], after[0]))
    return out


def check(got, rows):
    want = edited_texts(rows)
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for doc_id, text, edited, after in want:
        r = by[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        same = lambda a, b: 1.0 if a == b else 0.0 if not a or not b else np.mean([a[k:k + 8] == b[k:k + 8] for k in range(0, len(a), 8)])
        assert r.near_edited == pytest.approx(same(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(same(r.fingerprint, by[after].fingerprint))
    return by


def test_query(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    by = check(M.op3_fingerprints(spark, small).collect(), docs)
    texts = dict(docs)
    prints = {}
    for i, t in texts.items():
        assert prints.setdefault(t, by[i].fingerprint) == by[i].fingerprint
    # the edited text's fingerprint is the one that the text would get
    edited = [(i, e) for i, _, e, _ in edited_texts(docs)][:40]
    again = M.fingerprints(spark.createDataFrame(edited, "doc_id long, text string")).collect()
    assert {r.doc_id: r.fingerprint for r in again} == {i: by[i].edited_fingerprint for i, _ in edited}
    # the collision rate is an unbiased estimate of the generalised Jaccard similarity
    gaps = []
    for i, text, e, _ in edited_texts(docs):
        a, b = (Counter(x.lower().split()) for x in (text, e))
        if a and b:
            gaps.append(by[i].near_edited - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(gaps)) < 0.02 and np.std(gaps) < 0.12


def test_weights_matter(spark):
    rows = [(0, " ".join(["a"] * 9 + ["b"])), (1, " ".join(["a"] * 3 + ["b"] * 7))]
    words = spark.createDataFrame([(k, t, n, m) for k, t, n, m in [(0, 11, 9, 3), (0, 12, 1, 7)] * 1], "key long, term long, x long, y long")
    many = words.withColumn("key", F.explode(F.sequence(F.lit(0), F.lit(299)))).withColumn("term", F.xxhash64("key", "term"))
    r = M.samples(many, ["key"], ["x", "y"]).select(M.likeness(F.col("x"), F.col("y")).alias("l")).agg(F.avg("l")).first()[0]
    assert r == pytest.approx((3 + 1) / (9 + 7), abs=0.02) and rows


def test_edge_rows(edge_docs, edge_rows, no_docs, spark):
    got = M.fingerprints(edge_docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in edge_rows)
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[2] == {""} and prints[3] == {""} and prints[0] == prints[1] and prints[5] == prints[6]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert M.fingerprints(no_docs).collect() == []
    (one,) = M.fingerprints(spark.createDataFrame([(4, "ab cd ef")], "doc_id long, text string")).collect()
    assert one.edited_sha256 == hashlib.sha256(b"ab cd ab").hexdigest() and one.near_next == 1.0
