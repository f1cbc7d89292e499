import random
from collections import defaultdict

import corpus_pipeline as P

from .conftest import words


def kept(rows, shingle=5, percent=80):
    """Ids that stay: the smallest of each component, over all pairs; texts without words stay."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            n = len(s & sets[j])
            if n and 100 * n >= percent * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[root(i)].append(doc_id)
    return sorted(min(g) for g in groups.values())


def edited(n, seed=11):
    """Texts with copies of 0 to 12 edited words of 200: many lie between the stage's bound and the query's."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        base = words(500 + i, 200).split()
        out.append(" ".join(base))
        for _ in range(3):
            w = list(base)
            for _ in range(r.randint(0, 12)):
                w[r.randrange(len(w))] = f"edit{r.random()}"
            out.append(" ".join(w))
    out += [" ".join(words(900 + i, i % 6).split()) for i in range(12)] + ["a b c d", "a b c", "a b c d e"]
    r.shuffle(out)
    return list(enumerate(dict.fromkeys(out)))


def test_stage_takes_five_words_and_four_fifths(spark, small):
    rows = edited(40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(r.doc_id for r in P.ngram_join(spark, docs, small).collect())
    assert got == kept(rows) and len(got) < len(kept(rows, 3, 90))


def test_stage_large_groups(spark, small, monkeypatch):
    from geoprofile.llm import ngram_join as M
    monkeypatch.setattr(M, "BLOCK", 16)
    monkeypatch.setattr(M, "SMALL", 4)
    r = random.Random(3)
    base = words(77, 200).split()
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(r.randint(0, 12)):
            w[r.randrange(len(w))] = f"edit{r.random()}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in P.ngram_join(spark, docs, small).collect()) == kept(rows)


def test_stage_exchanges_near_copies_only(spark, small, monkeypatch):
    """Unlike texts in which nearly every run of five words stands in others too: no more than the near copies' keys meet."""
    from geoprofile.llm import ngram_join as M
    r = random.Random(8)
    vocabulary = [f"w{k}" for k in range(6)]
    rows = [(i, " ".join(r.choices(vocabulary, k=200))) for i in range(150)]
    rows += [(1000 + i, rows[i][1].replace(" ", " edited ", 1)) for i in range(15)]
    seen = []
    monkeypatch.setattr(M, "prefix_rows", lambda signed, whole=M.prefix_rows: seen.append(whole(signed)) or seen[0])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(x.doc_id for x in P.ngram_join(spark, docs, small).collect()) == kept(rows)
    found = {}
    for x in seen[0].collect():
        found[x.token] = found.get(x.token, 0) + 1
    assert 2 * 15 <= sum(n for n in found.values() if n > 1) < 3600  # a text has about 80 keys; by single tokens 6,209 rows would meet
