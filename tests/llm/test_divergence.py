import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from geoprofile.llm import divergence as M

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=50):
    """rows: (text, lang, source)."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    kept = {lang: [t for t, n in c.items() if n >= least] for lang, c in docs.items()}
    out = []

    def shares(count, words):
        total, v = sum(count[t] for t in words), len(words)
        return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * v) for t in words}

    for lang in {x for x, _ in counts}:
        words = kept[lang]
        mine = {s: shares(c, words) for (x, s), c in counts.items() if x == lang}
        whole = shares(sum((c for (x, _), c in counts.items() if x == lang), Counter()), words)
        for s, p in mine.items():
            parts = {"pair": [(sum(abs(p[t] - q[t]) for t in words), o) for o, q in mine.items() if o != s],
                     "term": [(p[t] - whole[t], t) for t in words if counts[lang, s][t] and p[t] > whole[t]]}
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1) if part == "pair" or i <= top]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


SCHEMA = "text string, lang string, source string, value string, rank int, doc_id long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, 1) for r in rows], SCHEMA).repartition(5)


def corpus(seed, n=400, sources=9):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdéüß中") for _ in range(r.randint(1, 4))) for _ in range(900)]
    rows = []
    for _ in range(n):
        words = [vocabulary[min(int(r.paretovariate(0.6)), 900) - 1] for _ in range(r.randint(0, 120))]
        text = "".join(w.upper() + r.choice([" ", ".", "-3-", "\n", "\x00", "_"]) if r.random() < 0.2 else w + " " for w in words)
        rows.append((text, r.choice(["en", "en", "en", "xy"]), f"s{min(int(r.paretovariate(0.8)), sources)}"))
    return rows


@pytest.mark.parametrize("least,top", [(30, 50), (2, 3)])
def test_against_brute_force(spark, least, top):
    rows = corpus(3) + [(None, None, None), ("", "en", "quiet"), (None, "zz", "a"), ("x", "zz", "b"), ("one source", "lone", "s"), (None, "en", None)]
    rows += [rows[0]] * 40 + [("hot " * 50000, "en", "s1")]
    assert got(M.divergence(frame(spark, rows), least, top)) == brute(rows, least, top)


def test_parts_blocks_and_flushes_give_the_same(spark, monkeypatch):
    rows = corpus(4, 300, 40)
    monkeypatch.setattr(M, "PART", 4)
    monkeypatch.setattr(M, "SUPER", 1)
    monkeypatch.setattr(M, "HELD", 200)
    monkeypatch.setattr(M, "RUN_BYTES", 500)
    monkeypatch.setattr(M, "LEAST_BITS", 32768)
    monkeypatch.setattr(M, "MOST_BITS", 32768)
    monkeypatch.setattr(M, "CHUNK_CELLS", 7)
    assert got(M.divergence(frame(spark, rows), 2)) == brute(rows, 2)


def test_edge_rows(edge_docs, edge_rows):
    assert got(M.divergence(edge_docs, 2)) == brute([r[1:4] for r in edge_rows], 2)


def test_empty(no_docs):
    assert M.divergence(no_docs).collect() == []


def test_large_counts_stay_exact(spark):
    big = 10**14 + 7
    row = spark.createDataFrame([(big, 3 * 10**14 + 1, 10**6)], "c long, n long, v long")
    assert row.select(M.share(row.c, row.n, row.v)).first()[0] == M._exact_share(big, 3 * 10**14 + 1, 10**6) == 1 + 10**9 * (big + 5) // (3 * 10**14 + 1 + 5 * 10**6)


def test_cells_of_a_block():
    mask = np.array([2**64 - 1] * 4, np.uint64)
    held = M.Levels([(10, 256, [(10, 1, 0, 0, 0)]), (8, 256, [(4, 1, 0, 0, 0), (4, 2, 0, 0, 0)]), (0, 256, [])], mask)
    p = lambda c, n: 1 + 10**9 * (c + 5) // (n + 5 * 256)
    want = abs(p(10, 10) - p(4, 8)) + abs(p(0, 10) - p(4, 8)) + 254 * abs(p(0, 10) - p(0, 8))
    assert M.block_distances(held, 0, held, 1).tolist() == [want, abs(p(10, 10) - p(0, 0)) + 255 * abs(p(0, 10) - p(0, 0))]
