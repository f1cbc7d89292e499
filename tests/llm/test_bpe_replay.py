import base64
import hashlib

import public_tokenizers as P
import pytest
import regex
import tiktoken
from geoprofile.llm import bpe_replay as M
from hypothesis import given, settings
from hypothesis import strategies as st

FILE = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, FILE.splitlines())}
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def replay():
    return M.Replay(RANKS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("aat hé\n\x1c 1", max_size=60), max_size=6))
def test_as_the_rank_library(replay, texts):
    split, ids, counts = M.encode_run(replay, regex.compile(P.PATTERN), [t.encode() for t in texts])
    ends = counts.cumsum()
    for text, pieces in zip(texts, split):
        assert [t for p in pieces for t in ids[ends[p] - counts[p]:ends[p]].tolist()] == ENC.encode_ordinary(text)


def test_ranks_out_of_order():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 900, b"abc": 300, b"cd": 800, b"bcd": 950, b"abcabc": 299, b"aa": 500, b"aaa": 400}
    mine, enc = M.Replay(ranks), tiktoken.Encoding("o", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    words = [b"abcd", b"abcabcabcd", b"aaaaaaa", b"abab", b"bcdabcaaab", b"d"]
    ids, counts = mine.encode(words)
    at = 0
    for w, n in zip(words, counts.tolist()):
        assert ids[at:at + n].tolist() == enc.encode_ordinary(w.decode())
        at += n


def test_edge_rows(edge_docs, edge_rows, no_docs):
    want = sorted((str(r[0]), len(e := ENC.encode_ordinary(r[1] or "")), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(),
                   hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in edge_rows)
    got = M.round_trip_digests(edge_docs, FILE, P.PATTERN).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    encoded = M.encode_texts(edge_docs, FILE, P.PATTERN)
    assert sorted(len(r.ids) for r in encoded.collect()) == sorted(w[1] for w in want)
    assert sorted(hashlib.sha256(r.decoded).hexdigest() for r in M.decode_ids(encoded, FILE).collect()) == sorted(w[3] for w in want)
    assert M.round_trip_digests(no_docs, FILE, P.PATTERN).collect() == []


def test_query(spark, small):
    got = {r.doc_id: r for r in M.op8_byte_bpe(spark, small).collect()}
    for doc_id, text in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        e = ENC.encode_ordinary(text)
        assert got[doc_id].n_tokens == len(e) and got[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, e)).encode()).hexdigest()
