import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from geoprofile.llm import ngram_join as M
from geoprofile.llm.components import components

from .conftest import SCHEMA, words


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def brute(rows):
    """(id, set size, component) of every row, over all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j > i).items():
            if 100 * n >= 90 * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return Counter((doc_id, len(sets[i]), least.get(root(i))) for i, (doc_id, _) in enumerate(rows))


def got(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def variants(n, seed=4):
    """A large group of near copies, many at the border of similarity, and texts that share a common line."""
    r = random.Random(seed)
    base = words(seed, 200).split()
    line = "this line stands in very many of the texts here"
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = f"edit{r.random()}"
        out.append(" ".join(w))
    out += [line + " " + words(1000 + i, r.randint(1, 40)) for i in range(n)]
    out += [t.replace(" ", "\n", 3) + " more" for t in out[-20:]]
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("block,small", [(1024, 32), (16, 4)])
def test_large_groups(spark, monkeypatch, block, small):
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "SMALL", small)
    rows = variants(150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert got(M.near_groups(df)) == want and 1 < len({c for _, _, c in want}) < len(rows)


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert got(M.op10_ngram_join(spark, small)) == brute(rows)


def test_edge_rows(edge_docs, edge_rows, no_docs, spark):
    assert got(M.near_groups(edge_docs)) == brute([r[:2] for r in edge_rows])
    assert M.near_groups(no_docs).collect() == []
    lone = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert got(M.near_groups(lone)) == {(None, 1, None): 2}
    kept = M.drop_near_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    parts = {c for _, n, c in brute([r[:2] for r in edge_rows]) if n}
    ids = [r.doc_id for r in kept.collect()]
    assert parts - {None} <= set(ids)
    clash = spark.createDataFrame([(1, words(3, 50), 1), (2, words(3, 50) + " x", 2)], "doc_id long, text string, component_id int")
    assert [r.doc_id for r in M.drop_near_copies(clash).collect()] == [1]
    assert M.drop_near_copies(spark.createDataFrame([], SCHEMA)).collect() == []


def test_prefixes_meet_under_every_order():
    r = np.random.default_rng(0)
    orders = M.Orders(np.arange(50, dtype=np.uint64), r.integers(1, 9, 50))
    for n in (1, 2, 9, 10, 11, 57, 300):
        for _ in range(20):
            a = np.unique(r.integers(0, 100 + n * 3, n).astype(np.uint64))
            drop = int(0.1 * len(a))
            b = a[: len(a) - drop]
            assert M.linked(a, b, len(b))
            assert all(np.isin(orders.prefix(a, k), orders.prefix(b, k)).any() for k in range(3))


def test_only_what_may_meet_is_exchanged(spark, monkeypatch):
    """Of prefixes, the tokens that stand in two rows, with their places; of classes, the wanted ones.  A full bitmap lets all pass."""
    r = np.random.default_rng(5)
    p0 = [r.integers(-2**63, 2**63, n).tolist() for n in [0, 5, 1, 40] * 50]
    for k in range(1, 200, 4):
        p0[k][k % 5] = p0[(k + 40) % 200][2]
    signed = spark.createDataFrame([(int(c), len(p) * 9, p, [k, 1], [k, 2, 3]) for k, (c, p) in enumerate(zip(r.integers(-2**63, 2**63, 200), p0))],
                                   "class long, size int, p0 array<long>, p1 array<int>, p2 array<int>").repartition(3)
    every = Counter((x, c, size, at) for c, size, p, _, _ in signed.collect() for at, x in enumerate(p))
    seen = Counter(x for x, *_ in every.elements())
    twice = Counter(row for row in every.elements() if seen[row[0]] > 1)
    assert 0 < twice.total() < every.total() / 4
    monkeypatch.setattr(M, "SIGNED_ROWS", 7)
    assert Counter(map(tuple, M.prefix_rows(signed).collect())) == twice
    wanted = signed.filter("pmod(class, 7) = 3").select("class")
    want = sorted(map(tuple, signed.filter("pmod(class, 7) = 3").select("class", "size", "p1", "p2").collect()))
    assert sorted(map(tuple, M.of_classes(signed, wanted).collect())) == want and 0 < len(want) < 60
    monkeypatch.setattr(M, "bitmap_size", lambda keys: 32768)
    monkeypatch.setattr(M, "key_bitmap", lambda places, size: np.full(size // 8, 255, np.uint8))
    assert Counter(map(tuple, M.prefix_rows(signed).collect())) == every
    assert M.of_classes(signed, wanted).count() == 200


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randint(0, 400), r.randint(0, 400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {x: root(x) for x in up}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_marks_rule_out_what_cannot_be_linked_and_no_more():
    r = np.random.default_rng(8)
    base = r.integers(0, 2**64, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[: 400 - k], r.integers(0, 2**64, m, dtype=np.uint64)))) for k in (0, 9, 20, 40, 90, 300) for m in (0, 1, 20, 60)]
    sets += [base[:1], base[:2], base[5:7], np.unique(r.integers(0, 2**64, 4000, dtype=np.uint64))]
    size, every = np.array([len(x) for x in sets]), np.arange(len(sets))
    shared = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    for percent in (80, 90):
        may = M.may_link(M.marks(sets), size, every, every, percent)
        want = 100 * shared >= percent * (size[:, None] + size - shared)
        assert may[want].all() and 0 < (may & ~want).sum() < (~want).sum() / 2


def test_close_pairs_are_told_before_prefixes_are_sent(spark):
    r = np.random.default_rng(9)
    base = r.integers(0, 2**64, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[:k], r.integers(0, 2**64, 200 - k, dtype=np.uint64)))) for k in (200, 199, 195, 150, 60, 10)]
    signed = spark.createDataFrame([(k, len(x), [], [], [], *m) for k, (x, m) in enumerate(zip(sets, M.marks(sets).tolist()))], M.SIGNED)
    pairs = spark.createDataFrame([(a, b) for a in range(6) for b in range(a + 1, 6)], "u long, v long")
    assert sorted(map(tuple, M._close(pairs, signed, 90).collect())) == [(0, 1), (0, 2), (1, 2)]


def test_large_sets_in_blocks_are_told_by_prefixes(spark, monkeypatch):
    """Sets too large for their marks: pairs that share one token alone are no candidates, and links of large groups stay."""
    monkeypatch.setattr(M, "SMALL", 4)
    r = np.random.default_rng(3)
    common = " ".join(f"c{k}" for k in range(400))
    rows = [(i, common + " " + " ".join(f"w{x}" for x in r.integers(0, 10**6, 3000))) for i in range(12)]
    rows += [(100 + i, rows[i][1] + " and more") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(M.near_groups(docs)) == brute(rows)
    lists = [np.array([7, 10 + i // 2, 50 + i]) for i in range(12)]
    size, mark = np.full(12, 10**4), np.zeros((12, M.MARK_BITS // 64), np.int64)
    apart = [[x[1:] for x in lists], [x[1:] for x in lists]]
    assert len(M.block_links(list(range(12)), np.zeros(12, bool), size, apart, None, 80, mark)) == 6
    assert len(M.block_links(list(range(12)), np.zeros(12, bool), size, [[x[:0] for x in lists]] * 2, None, 80, mark)) == 11


@pytest.mark.parametrize("percent", [51, 80, 90, 100])
def test_linked_sets_share_a_key_of_neighbours(percent):
    r = np.random.default_rng(percent)
    orders, linked = M.Orders(np.unique(r.integers(0, 2**64, 99, dtype=np.uint64)), r.integers(1, 9, 99)), 0
    for n in (1, 2, 9, 10, 11, 57, 300):
        for k in range(200):
            a = np.unique(np.concatenate((orders.common[:n // 4], r.integers(0, 2**64, n - n // 4, dtype=np.uint64))))
            gone = int(r.random() ** 2 * (100 - percent) / 100 * len(a))
            gone = np.arange(gone) * 2 + 1 if k % 2 and 2 * gone < len(a) else r.permutation(len(a))[:gone]  # every other token: so most keys go
            b = np.unique(np.append(np.delete(a, gone), r.integers(0, 2**64, int(r.random() ** 2 * len(a)) if k % 3 else 0, dtype=np.uint64)))
            if len(b) and M.linked(a, b, len(np.intersect1d(a, b)), percent):
                linked += 1
                assert np.isin(*orders.neighbours([a, b], percent)).any()
    assert linked > 300


def test_texts_that_share_single_tokens_do_not_meet(spark, monkeypatch):
    """Unlike texts of few words, so that nearly every shingle stands in others too, and as many near copies: only these are exchanged."""
    r = random.Random(6)
    vocabulary = [f"w{k}" for k in range(25)]
    rows = [(i, " ".join(r.choices(vocabulary, k=250))) for i in range(300)]
    rows += [(1000 + i, rows[i][1].replace(" ", " edited ", 1)) for i in range(30)]
    seen = []
    monkeypatch.setattr(M, "prefix_rows", lambda signed, whole=M.prefix_rows: seen.append(whole(signed)) or seen[0])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(M.near_groups(docs)) == brute(rows)
    found = Counter(r.token for r in seen[0].collect())
    met = sum(n for n in found.values() if n > 1)
    assert 2 * 30 <= met < 2 * 30 * 60  # a text has about 50 keys; by single tokens 7,945 rows would meet


def test_few_shared_tokens_in_a_hundred_are_met_by_tokens(spark):
    """Half the union or less may be the same: neighbours tell nothing then."""
    rows = [(0, words(1, 40)), (1, " ".join(words(1, 40).split()[:26])), (2, words(9, 40))]
    out = {r.doc_id: r.component_id for r in M.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), shingle=1, percent=40).collect()}
    assert out == {0: 0, 1: 0, 2: 2}
