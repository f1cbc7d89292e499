import hashlib
from collections import Counter, defaultdict

import pytest
from geoprofile.llm import exact_dedup as M


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, sha = max(known, default=None), hashlib.sha256(text.encode()).hexdigest()
        left = 1
        for i in sorted(ids, key=lambda x: (x is None, x or 0)):
            kept = bool(i == keep and left)
            left -= kept
            out[i, keep, len(ids), kept, sha] += 1
    return out


@pytest.mark.parametrize("bits", [64, 3])  # three bits: nearly every digest collides
def test_against_brute_force(edge_docs, edge_rows, bits):
    got = Counter(map(tuple, M.exact_dedup(edge_docs, digest_bits=bits).collect()))
    assert got == brute(edge_rows)


def test_drop_copies_keeps_one_row_of_each_text(edge_docs, edge_rows):
    got = M.drop_copies(edge_docs)
    assert got.columns == edge_docs.columns
    rows = got.collect()
    assert sorted((r.text or "") for r in rows) == sorted({r[1] or "" for r in edge_rows})


def test_empty(no_docs):
    assert M.exact_dedup(no_docs).collect() == [] and M.drop_copies(no_docs).collect() == []


def test_chunks_follow_content():
    import random
    data = random.Random(0).randbytes(200_000)
    a, b = list(M.chunked([data, b"0123" + data]))
    assert b"".join(a) == data and b"".join(b) == b"0123" + data
    assert max(map(len, a)) <= M.MAX_CHUNK and len(set(a) & set(b)) > 0.9 * len(a)
    assert list(M.chunked([b"", b"x", b"z" * 40_000])) == [[], [b"x"], [b"z" * 16384, b"z" * 16384, b"z" * 7232]]
