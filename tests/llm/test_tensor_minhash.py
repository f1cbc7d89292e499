import random
import re
from collections import Counter

import numpy as np
import pytest
from geoprofile.llm import tensor_minhash as M
from geoprofile.llm.ngram_join import shingle_sets

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=4):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n=4, percent=80):
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in by[x] if j < i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return Counter((doc_id, len(sets[i]), least.get(root(i)), doc_id == least.get(root(i))) for i, (doc_id, _) in enumerate(rows))


def got(df):
    return Counter(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()))


SCHEMA = "doc_id long, text string, class long, signature string, component_id long"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, None, "x", 3) for r in rows], SCHEMA).repartition(parts)


def corpus(seed, families=40, hot=0):
    """Chains of edits, copies, short texts and, if ``hot``, texts that share a passage."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(families):
        base = [word() for _ in range(r.choice([1, 3, 4, 5, 8, 60, 150]))]
        for _ in range(r.randint(1, 8)):
            texts.append(" ".join(base))
            if r.random() < 0.8:
                base = list(base)
                for _ in range(r.randint(0, 1 + len(base) // 40)):
                    base[r.randrange(len(base))] = word()
    texts += [passage + " " + " ".join(word() for _ in range(r.randint(5, 50))) for _ in range(hot)]
    texts += [None, "", " \t\n", "One", "one", "a b c", "a b c d", "A\x1cB"]
    r.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)] + [(None, texts[1]), (None, "alone alone"), (0, texts[0])]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    want = brute(rows)
    assert sum(1 for d, _, c, _ in want if d != c) > 40
    assert got(M.near_classes(frame(spark, rows))) == want


def test_hot_groups_in_blocks(spark, monkeypatch):
    """Texts with a common passage of most of their words meet in many keys, in groups larger than a block."""
    monkeypatch.setattr(M, "BLOCK", 8)
    monkeypatch.setattr(M, "CHUNK", 20)
    monkeypatch.setattr(M, "RUN", 4)
    monkeypatch.setattr(M, "RUN_BYTES", 3000)
    monkeypatch.setattr(M, "KEY_ROWS", 7)
    rows = corpus(5, 12, hot=150)
    assert got(M.near_classes(frame(spark, rows))) == brute(rows)


def test_other_shingles_and_threshold(spark):
    rows = corpus(6, 30)
    assert got(M.near_classes(frame(spark, rows), shingle=2, percent=90)) == brute(rows, 2, 90)


def test_groups_that_a_representative_does_not_join(spark):
    """The least class is like nothing else, the others are linked: found in the second round."""
    source = frame(spark, [(i, t) for i, t in enumerate(chain(40))])
    assert got(M.near_classes(source)) == brute(list(enumerate(chain(40))))


def chain(n):
    base = [f"w{i}" for i in range(200)]
    out = []
    for i in range(n):  # neighbours are near, ends are not
        out.append(" ".join(base))
        base = [f"new{i}x{k}" if k % 40 == i % 40 and i < 40 else w for k, w in enumerate(base)]
    return out


def test_crossings_ask_only_outside_the_largest_component(spark):
    own = [np.sort(np.unique(np.random.default_rng(k).integers(0, 1 << 63, 100, dtype=np.uint64))) for k in (1, 2)]
    band, ranges = M.bands(M.signatures(own)), M.bins(own)
    kind = [0, 0, 0, 0, 0, 0, 1]
    facts = [(i, 130 if i == 5 else 100, bytearray(band[0].tobytes()), bytearray(ranges[kind[i]].tobytes())) for i in range(7)]
    classes = spark.createDataFrame(facts, "class long, n_shingles long, bands binary, bins binary")
    # tables 0 and 5 have the same members, table 9 a part of them: each pair is taken in table 0
    met = spark.createDataFrame([(256 * k + t, i, 0) for k, t in ((7, 5), (8, 0)) for i in range(7)] + [(9, i, 0) for i in (0, 3, 4)], "key long, class long, least long")
    joined = spark.createDataFrame([(i, 0) for i in range(3)], "node long, component long")
    pairs = sorted(map(tuple, M.crossings(met, classes, joined, 80).collect()))
    # 3 and 4 with 0, 1, 2 and each other; 5 is too long, 6 has other bins
    assert pairs == sorted([(a, b) for b in (3, 4) for a in range(3)] + [(3, 4)])


def test_crossings_send_a_member_to_a_task_once(spark, monkeypatch):
    """A member that asks and answers in the same task is one row there; in blocks, pairs are the same."""
    own = [np.sort(np.unique(np.random.default_rng(1).integers(0, 1 << 63, 100, dtype=np.uint64)))]
    band, ranges = M.bands(M.signatures(own)), M.bins(own)
    classes = spark.createDataFrame([(i, 100, bytearray(band[0].tobytes()), bytearray(ranges[0].tobytes())) for i in range(30)], "class long, n_shingles long, bands binary, bins binary")
    met = spark.createDataFrame([(256 * 7, i, 0) for i in range(30)], "key long, class long, least long")
    joined = spark.createDataFrame([(i, 0) for i in range(6)], "node long, component long")
    want = sorted((a, b) for a in range(30) for b in range(max(a + 1, 6), 30))
    sent = []
    real = M._crossing

    def counted(percent):
        rows = spark.sparkContext.accumulator(0)
        sent.append(rows)

        def run(batches):
            def told():
                for b in batches:
                    rows.add(b.num_rows)
                    yield b
            return real(percent)(told())
        return run

    monkeypatch.setattr(M, "_crossing", counted)
    assert sorted(map(tuple, M.crossings(met, classes, joined, 80).collect())) == want
    assert sent[0].value == 30
    monkeypatch.setattr(M, "BLOCK", 5)
    monkeypatch.setattr(M, "CHUNK", 7)
    assert sorted(map(tuple, M.crossings(met, classes, joined, 80).collect())) == want


@pytest.mark.parametrize("n,error", [(60, 3), (300, 4), (4000, 5)])
def test_bins_estimate_similarity(n, error):
    r = np.random.default_rng(3)
    for share in (0.5, 0.8):
        both = int(2 * n * share / (1 + share))
        off = []
        for _ in range(60):
            x = np.unique(r.integers(0, 1 << 64, 2 * n - both, dtype=np.uint64))
            r.shuffle(x)
            a, b = np.sort(x[:n]), np.sort(x[n - both:])
            off.append(M.alike(*M.bins([a, b])) - 100 * both / (2 * n - both))
        assert abs(np.mean(off)) < 2 and max(map(abs, off)) < error + 1.5
        assert min(off) > -M.MARGIN


def test_keys_combine_bands():
    sign = M.signatures(shingle_sets([b"a b c d e f g", b"a b c d e f g h"], 4))
    band = M.bands(sign)
    keys = M.table_keys(band)
    assert keys.shape == (2, M.TABLES) and (keys[0] % 256 == np.arange(M.TABLES)).all()
    same = (sign[0] == sign[1]).reshape(2, M.BANDS, M.ROWS).all(2)
    assert ((keys[0] == keys[1]).reshape(M.BANDS, M.BANDS) == np.outer(same[0], same[1])).all()


def test_edge_rows(edge_docs, edge_rows):
    assert got(M.near_classes(edge_docs)) == brute([r[:2] for r in edge_rows])


def test_empty(no_docs):
    assert M.near_classes(no_docs).collect() == []


def test_query_on_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert got(M.op13_tensor_minhash(spark, small)) == brute(rows)
