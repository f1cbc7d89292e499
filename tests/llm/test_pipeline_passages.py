import random
import re
from collections import Counter

import corpus_pipeline as P
from geoprofile.llm import suffix_dedup as M

from .conftest import words


def without_passages(texts, n=51):
    """Texts without the words of every run of n words that stands twice, by counting all runs."""
    data = [(t or "").split() for t in texts]
    count = Counter(tuple(w[i:i + n]) for w in data for i in range(len(w) - n + 1))
    out = []
    for t, w in zip(texts, data):
        gone = [False] * (len(w) + 1)
        for i in range(len(w) - n + 1):
            if count[tuple(w[i:i + n])] > 1:
                gone[i:i + n] = [True] * n
        drop = set()
        for k, m in enumerate(re.finditer(r"\S+", t or "")):
            if gone[k]:
                drop.update(range(m.start(), m.end()))
                if gone[k + 1]:
                    drop.update(range(m.end(), m.end() + len(t[m.end():]) - len(t[m.end():].lstrip())))
        out.append(t if t is None else "".join(c for i, c in enumerate(t) if i not in drop))
    return out


def short_words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(n))


def planted():
    r = random.Random(8)
    passage, less = short_words(1, 52), short_words(2, 50)
    assert len(passage.encode()) < 400
    rows = []
    for i in range(40):
        w = short_words(100 + i, r.randint(5, 150)).split()
        if i % 3 == 0:
            w.insert(r.randrange(len(w)), passage.replace(" ", " \n" if i % 2 else " ") if i % 4 else passage)
        if i % 5 == 0:
            w.insert(r.randrange(len(w)), less)
        rows.append((i, " ".join(w)))
    return rows + [(90, rows[7][1]), (90, "x " * 60), (None, None), (92, "é" * 700), (None, rows[3][1])]


def test_passages_against_brute_force(spark, edge_docs, edge_rows):
    for rows, docs in ((planted(), None), (edge_rows, edge_docs)):
        docs = docs or spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        left = M.strip_passages(docs)
        assert left.columns == docs.columns
        want = without_passages([x[1] for x in rows])
        assert Counter((x.doc_id, x.text) for x in left.collect()) == Counter((x[0], t) for x, t in zip(rows, want))
        assert sum(len(t or "") for t in want) < sum(len(x[1] or "") for x in rows)


def test_stage_cuts_passages_of_few_bytes(spark, small):
    passage = short_words(1, 51)
    assert len(passage.encode()) < 300
    rows = [(i, f"{short_words(20 + i, 30)} {passage} {short_words(40 + i, 30)}") for i in range(4)]
    rows += [(i, short_words(60 + i, 9) + " " + "x".join(words(5, 130).split()) + " " + short_words(80 + i, 9)) for i in range(4, 6)]
    rows += [(i, short_words(60 + i, 9) + " " + short_words(3, 50) + " " + short_words(80 + i, 9)) for i in range(6, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in P.suffix_dedup(spark, docs, small).collect()}
    assert all(left[i] == f"{short_words(20 + i, 30)}  {short_words(40 + i, 30)}" for i in range(4))
    assert all(len(left[i]) < 150 < 400 < len(rows[i][1]) for i in (4, 5))  # one long word: by bytes
    assert all(left[i] == rows[i][1] for i in (6, 7))  # 50 words stay
