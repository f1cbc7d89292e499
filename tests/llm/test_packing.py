import itertools
import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from geoprofile.llm import common
from geoprofile.llm import packing as M
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def plain():
    from public_tokenizers import path
    return Tokenizer.from_file(str(path("word_bpe_49k.json")))  # as it is


@pytest.fixture(scope="module")
def words():
    return M.WordTokens(M.tokenizer_spec())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=50) | st.text("aΣ'ts é́\x0b\x1c\x85<|>. \n1", max_size=50), min_size=1, max_size=5))
def test_ids_of_words_are_ids_of_the_text(plain, words, texts):
    stream, ends = words.encode([t.encode() for t in texts])
    start = 0
    for text, end in zip(texts, ends.tolist()):
        assert stream[start:end].tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]
        start = end


def test_control_strings_are_the_files_own(plain, words):
    texts = ["<|endoftext|>", "a<|startoftext|>B  c.<|endoftext|>\u0301x", "<|ENDOFTEXT|> <|EndOfText|>", "plain <|endoftext", "<|endoftext|>", "", "b <|startoftext|>"]
    assert plain.encode(texts[0], add_special_tokens=False).ids == [49407]
    test_ids = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):  # new, then known
        stream, ends = words.encode([t.encode() for t in texts])
        assert [stream[a:b].tolist() for a, b in zip([0, *ends], ends)] == [[*ids, 1] for ids in test_ids]


class Told:
    """A tokenizer that notes what it is given."""

    def __init__(self, real, given):
        self.__dict__.update(real=real, given=given)

    def __getattr__(self, name):
        def call(texts, *args, **named):
            self.given.extend([texts] if isinstance(texts, str) else texts)
            return getattr(self.real, name)(texts, *args, **named)
        return call


def test_letters_are_tokenized_once_whatever_marks_follow(plain, monkeypatch):
    words = M.WordTokens(M.tokenizer_spec())
    given = []
    monkeypatch.setattr(words, "tokenizer", Told(words.tokenizer, given))
    texts = ["Tionlyhe tionlyhe, TIONLYHE. tionlyhe*** tionlyhe", "tionlyhe; ou\u00e9le, ou\u00e9le ou\u00e9le!?"]
    stream, ends = words.encode([t.encode() for t in texts])
    assert [stream[a:b].tolist() for a, b in zip([0, *ends], ends)] == [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert sum(t.split().count("tionlyhe") for t in given) == 1 and sum("tionlyhe" in w for t in given for w in t.split()) == 1
    assert sum("ou\u00e9le" in w for t in given for w in t.split()) == 1


@pytest.mark.parametrize("text", ["\u0130, \u0130 a, \u0130.", "\u0149' \u00aa, \u00b5. \u00df!", "x\u0323, e\u0301. \u0958- \u0958", "\u03a3, \u0391\u03a3. \u0391\u03a3'", "it's, it's 'tis, don't. o'", "a_b a_ _ __a, 1, a1, 1a.", "\u4e2d, \ud55c. \ufb01, \u01c5."])
def test_letters_that_normalizing_changes(plain, text):
    stream, ends = M.WordTokens(M.tokenizer_spec()).encode([text.encode(), (text + " " + text.upper()).encode()])
    assert stream[:ends[0]].tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]
    assert stream[ends[0]:].tolist() == [*plain.encode(text + " " + text.upper(), add_special_tokens=False).ids, 1]


def test_freed_memory_is_given_back_after_much_text(monkeypatch):
    """Once a task has read all its rows, and not for a few bytes."""
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    for size, want in ((100, 0), (common.MUCH + 1, 1)):
        calls.clear()
        batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["a" * size, None, "b"]})
        assert [len(d) for _, d in common.byte_batches(iter([batch, batch.slice(0, 0)]), 50)] == [1, 2] and len(calls) == want


def test_giving_back_frees_what_is_unused():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGESIZE")

    held = [bytes(50_000) for _ in range(2000)]
    held = held[-1:]  # the last stays, so that the heap's end does not fall by itself
    before = resident()
    common.give_back()
    assert resident() < before - 50_000_000 and len(held) == 1


def cost_of(ends, cost, window):
    total, last = 0, 0
    for e in ends:
        size = e - last
        assert 0 < size <= window
        total += cost[e] + M.PER_WINDOW + (0 if size & (size - 1) == 0 and size in cost["powers"](e) else window - size)
        last = e
    return total


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=9), st.integers(0, 2**31))
def test_cuts_are_the_cheapest(gaps, seed):
    window, cuts = 8, [0, *itertools.accumulate(gaps)]
    cost = np.random.RandomState(seed % 1000).randint(0, 9, len(cuts)).tolist()
    by = dict(zip(cuts, cost)) | {"powers": lambda e: [1 << q for q in range(4)] if e > cuts[-1] - window else []}
    best = min(cost_of([*c, cuts[-1]], by, window) for n in range(len(cuts)) for c in itertools.combinations(cuts[1:-1], n)
               if all(b - a <= window for a, b in zip([0, *c], [*c, cuts[-1]])))
    assert cost_of(M.best_cuts(cuts, cost, window), by, window) == best


def check(rows, texts, plain, window):
    """Every id in one piece; windows gapless; returns tokens and padding."""
    want = defaultdict(list)
    for i, t in texts:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[i, len(ids)].append(ids)
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id, r.doc_tokens].append(r)
    assert pieces.keys() == want.keys()
    for key, own in pieces.items():
        own.sort(key=lambda r: r.start)
        assert sum(r.length for r in own) == sum(map(len, want[key]))
        for r in own:
            assert r.length > 0 and zlib.crc32(want[key][0][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        if len(want[key]) == 1:
            assert [r.start for r in own] == [0, *itertools.accumulate(r.length for r in own)][:-1]
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *itertools.accumulate(r.length for r in own)][:-1]
        size = sum(r.length for r in own)
        assert size <= window
        padding += 0 if size & (size - 1) == 0 else window - size
    return sum(r.length for r in rows), padding


def test_edge_rows(edge_docs, edge_rows, no_docs, plain):
    for block in (M.BLOCK, 4096):  # with small blocks, long texts run on through several
        rows = M.pack(edge_docs, M.tokenizer_spec(), block=block).collect()
        check(rows, [(r[0], r[1]) for r in edge_rows], plain, M.WINDOW)
    assert M.pack(no_docs, M.tokenizer_spec()).collect() == []


def test_query(spark, small, plain):
    rows = M.op7_packing(spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    tokens, padding = check(rows, map(tuple, docs), plain, M.WINDOW)
    assert padding < 0.01 * tokens


def test_what_a_worker_keeps_goes_when_another_operator_reads():
    batch = pa.record_batch({"doc_id": pa.array([1]), "text": ["a"]})
    made = []
    get = lambda key: common.kept(key, lambda: made.append(key) or key)
    get("a"), get("a")
    assert list(common.byte_batches([batch], 10, "a")) and "a" in common.READY and made == ["a"]
    get("b")
    assert list(common.READY) == ["b"]
    assert list(common.byte_batches([batch], 10)) and not common.READY


def test_batches_are_small_unless_the_session_names_their_size(spark):
    docs = spark.range(3).selectExpr("id", "repeat('x', 3000000) text").coalesce(1)
    rows = lambda: [r.n for r in common.in_arrow(docs, lambda bs: (pa.record_batch({"n": [b.num_rows]}) for b in bs), "n long").collect()]
    spark.conf.unset(common.BATCH_SIZE)
    assert max(rows()) < 3
    spark.conf.set(common.BATCH_SIZE, 100 << 20)
    assert rows() == [3]
    spark.conf.unset(common.BATCH_SIZE)
