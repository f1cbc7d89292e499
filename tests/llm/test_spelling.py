import random
import re
import zlib
from collections import Counter

import pytest
from geoprofile.llm import spelling as M

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, least_length=7, least_count=2):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    by_part = {}
    for w in counts:  # words near each other have a deletion (or themselves) in common
        for k in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by_part.setdefault(k, []).append(w)
    forms, n_near, out = {}, {}, []
    for w, n in counts.items():
        close = {x for k in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))} for x in by_part[k] if near(w, x)}
        n_near[w] = len(close)
        best = min(close, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * n else None
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, n_near[w], counts[forms[w]] if forms[w] else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


SCHEMA = "doc_id long, text string, word string, root int"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(parts)


def corpus(seed, n=150, letters="abé", lengths=(3, 5)):
    """Words in chains of edits, with counts that fall by a factor of ten and more."""
    r = random.Random(seed)
    heads = ["".join(r.choice(letters) for _ in range(r.randint(*lengths))) for _ in range(30)] + ["ÿÿÿÿÿÿÿÿ", "ÿÿÿÿÿÿÿ", "aaaaaaaa", "÷×÷×÷×÷×"]
    rows = []
    for i in range(n):
        out = []
        for _ in range(r.randint(0, 80)):
            w = r.choice(heads[:8] if r.random() < 0.8 else heads)
            while r.random() < 0.2:
                at = r.randrange(len(w) + 1)
                w = w[:at] + r.choice([r.choice(letters), ""]) + w[at + r.randint(0, 1):] or "a"
            out.append(w.upper() if r.random() < 0.1 and "ÿ" not in w else w)
        rows.append((i, r.choice([" ", ", ", "1", "\n", "中"]).join(out)))
    return rows


@pytest.mark.parametrize("seed,lengths,least", [(1, (7, 9), 7), (2, (3, 5), 2), (3, (1, 2), 1)])
def test_against_brute_force(spark, seed, lengths, least):
    rows = corpus(seed, lengths=lengths) + [(7, None), (None, "nullident nullident nullidenz"), (9, ""), (3, "common " * 30000 + "commons " * 2500 + "commonss " * 200 + "commonsss " * 3)]
    want = brute(rows, least)
    assert any(w[1] and w[2] != w[1] for w in want)
    assert got(M.variants(frame(spark, rows), least_length=least)) == want


def test_shards_share_a_hot_prefix(spark, monkeypatch):
    """Most words begin and end alike, so one range spans nearly all shards."""
    r = random.Random(5)
    body = ["".join(r.choice("abc") for _ in range(r.randint(4, 6))) for _ in range(900)]
    texts = [" ".join("samefront" + r.choice(body) + "sameback" for _ in range(60)) for _ in range(120)]
    texts += [" ".join("".join(r.choice("ab") for _ in range(r.randint(7, 8))) for _ in range(60)) for _ in range(40)]
    rows = list(enumerate(texts))
    monkeypatch.setattr(M, "SHARD", 40)
    monkeypatch.setattr(M, "QUERIES", 7)
    monkeypatch.setattr(M, "HELD", 50)
    monkeypatch.setattr(M, "RUN_BYTES", 2000)
    assert got(M.variants(frame(spark, rows))) == brute(rows)


def test_very_long_words(spark):
    rows = [(i, w) for i, w in enumerate(["x" * 9000, "x" * 9000, "x" * 8999 + " " + "x" * 8999, "y" + "x" * 8999, "y" + "x" * 8999, "x" * 4000 + "z" + "x" * 4999] * 2)]
    assert got(M.variants(frame(spark, rows))) == brute(rows)


def test_scan_of_a_sorted_list():
    r = random.Random(8)
    entries = sorted({bytes(r.choice(b"ab\xff") for _ in range(r.randint(1, 6))) for _ in range(300)})
    held = M.SortedList(entries)
    for depth in (0, 1, 2):
        asked = [e for e in entries if len(e) >= depth] + [b"ab" + b"\xff" * 5]
        q, e = held.near(asked, [depth] * len(asked))
        found = sorted((asked[i], entries[j]) for i, j in zip(q, e))
        assert found == sorted((a, b) for a in asked for b in entries if a[:depth] == b[:depth] and near(a.decode("latin-1"), b.decode("latin-1")))


def test_skipped_shards_hold_no_near_word():
    r = random.Random(9)
    for _ in range(2000):
        query, entry = ("".join(r.choice("ab") for _ in range(r.randint(2, 7))) for _ in range(2))
        depth = r.randint(0, 1)
        for n in range(depth, len(entry) + 1):
            if query[:depth] == entry[:depth] and near(query, entry):
                assert M.may_reach(query.encode(), entry[:n].encode(), depth)
    assert not M.may_reach(b"abcdefgh", b"abcdxx", 4)


def test_marks():
    word = next(w for w in (f"word{chr(97 + i)}{chr(97 + j)}é" for i in range(26) for j in range(26)) if zlib.crc32(f"5:{w}".encode()) % 31 == 0)
    h = zlib.crc32(f"5:{word}".encode())
    assert M.marked(5, word.encode("latin-1")).decode("latin-1") == word[:h % len(word)] + word[h % len(word) + 1:]


def test_edge_rows(edge_docs, edge_rows):
    assert got(M.variants(edge_docs, least_length=3)) == brute([r[:2] for r in edge_rows], 3)


def test_empty(no_docs):
    assert M.variants(no_docs).collect() == []


def test_query_on_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert got(M.op11_spelling_variants(spark, small)) == brute(rows)
