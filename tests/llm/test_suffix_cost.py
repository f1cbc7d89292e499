"""Texts are searched many at a time, with the results that each alone gives, and in few rounds and little memory."""

import numpy as np
import pytest

from geoprofile.llm import suffix_array, suffix_dedup


@pytest.mark.parametrize("unit,length,gram", [(1, 60, 20), (8, 5, 2)])
def test_anchors_of_many_texts(unit, length, gram):
    random = np.random.default_rng(1)
    data = [bytes(random.integers(97, 100, unit * int(n), dtype=np.uint8)) for n in [0, length - 1, length, length + 1, *random.integers(0, 900, 150), 80_000]]
    data += [data[9] * 2, b"a" * unit * length * 3, data[-1], b""]
    of, *got = suffix_dedup.all_anchors(data, length, gram, unit)
    each = [suffix_dedup.anchors(t, length, gram, unit) for t in data]
    assert of.tolist() == np.repeat(np.arange(len(data)), [len(x[0]) for x in each]).tolist()
    for x, want in zip(got, zip(*each)):
        assert x.tolist() == np.concatenate(want).tolist()
    assert not len(suffix_dedup.all_anchors([b"", b"a" * (length - 1) * unit], length, gram, unit)[0])


@pytest.mark.parametrize("wide", [False, True])
def test_suffixes_are_sorted_by_three_ranks_at_once(monkeypatch, wide):
    rounds = []
    ordered = suffix_array.ordered

    def counted(group, then, last, most):
        rounds.append(len(group))
        return ordered(group, then, last, most << 24 if wide else most)  # too wide for one number

    monkeypatch.setattr(suffix_array, "ordered", counted)
    random = np.random.default_rng(2)
    shared = bytes(random.integers(97, 101, 400, dtype=np.uint8))
    strings = [bytes(random.integers(97, 101, n, dtype=np.uint8)) + shared + bytes(random.integers(97, 101, n, dtype=np.uint8)) for n in (1, 5, 40)] + [b"", b"ab", b"ab", b"aab"]
    shard = suffix_array.Shard(strings)
    sa, rank = shard.sorted()
    place = [(k, i) for k, t in enumerate(strings) for i in range(len(t))]
    want = sorted(range(len(place)), key=lambda p: (strings[place[p][0]][place[p][1]:], p))
    assert sa.tolist() == want and rank[sa].tolist() == list(range(len(sa)))
    assert len(rounds) <= 4  # sorted by 7, 21, 63, 189, 567 symbols
    assert {sa.dtype, rank.dtype, shard.left.dtype} == {np.dtype(np.int32)}
    assert [f.any() for f in suffix_array.repeated_windows(strings, 400)] == [True] * 3 + [False] * 4


def test_a_shard_is_searched_in_pieces_of_whole_anchors(monkeypatch):
    pieces = []
    search = suffix_dedup.repeated_windows
    monkeypatch.setattr(suffix_dedup, "repeated_windows", lambda strings, *more: pieces.append(len(strings)) or search(strings, *more))
    random = np.random.default_rng(3)
    gram = [bytes(random.integers(97, 101, 30, dtype=np.uint8)) for _ in range(60)]
    anchor = random.integers(0, 60, 200)
    body = [bytes([x]) + gram[a] + bytes([y]) for a, x, y in zip(anchor, *random.integers(97, 99, (2, 200)))]
    members = suffix_dedup.pa.table({"anchor": anchor, "cid": body, "body": body, "parts": np.where(anchor < 5, 2, 1)})
    whole = suffix_dedup._shard(31)(members)
    assert len(pieces) == 1
    monkeypatch.setattr(suffix_dedup, "PIECE", 16)
    assert suffix_dedup._shard(31)(members).equals(whole) and any(whole.column("runs").to_pylist())
    assert len(pieces) > 8 and sum(pieces[1:]) == pieces[0]
    assert suffix_dedup.whole_runs(np.zeros(0, int), 4) == [] and suffix_dedup.whole_runs(np.zeros(9, int), 4) == [slice(0, 9)]
    assert suffix_dedup.whole_runs(np.array([0, 1, 1, 2, 2, 2, 2, 2, 2, 3]), 2) == [slice(0, 3), slice(3, 9), slice(9, 10)]
