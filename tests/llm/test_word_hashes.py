import random

import numpy as np
import pytest
from geoprofile.llm import lm, suffix_dedup
from geoprofile.llm.word_hashes import word_hashes

SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace()]


@pytest.mark.parametrize("unicode", [False, True])
def test_words_are_those_of_split(unicode):
    r = random.Random(5)
    near = ["​", "‐", "¡", "、", "ᚁ", "Â", "₀", "\x00", "\x7f"]  # begin like a white space's bytes, and are none
    pieces = [*SPACES, *near, "a", "bc", "defghijk", "é", "lmnopqrst" * 2, "u" * 63, "v" * 64, "w" * 65, "x" * 700]
    texts = ["", " ", "a", *SPACES, *("".join(r.choices(pieces, k=r.randint(1, 60))) for _ in range(300))]
    data = [t.encode() for t in texts]
    found, ends = word_hashes(data, unicode)
    want = [t.split() if unicode else t.encode().split() for t in texts]
    assert ends.tolist() == np.cumsum([len(w) for w in want]).tolist()
    words = [w for ws in want for w in ws]
    assert len(set(zip(words, found.tolist()))) == len(set(words)) == len(set(found.tolist()))
    alone = [word_hashes([t], unicode)[0].tolist() for t in data]  # whatever stands beside a text
    assert [h for own in alone for h in own] == found.tolist()


def test_no_texts():
    found, ends = word_hashes([])
    assert len(found) == len(ends) == 0


def test_codes_of_a_batch_need_no_call_for_each_word(monkeypatch):
    calls = []
    real = suffix_dedup.xxhash.xxh3_64_digest
    monkeypatch.setattr(suffix_dedup.xxhash, "xxh3_64_digest", lambda x: calls.append(x) or real(x))
    codes = suffix_dedup.symbols([b"one two three", b"", "two　one".encode()], suffix_dedup.CODE)
    assert [len(c) for c in codes] == [24, 0, 16] and codes[0][:16] == codes[2][8:] + codes[2][:8] and not calls


def test_words_of_texts_for_the_language_model():
    data = [b"The the cat", b"", b" \x0b ", "THE É é".encode()]
    flat, sizes = lm.hashed(data)
    want = [w for t in data for w in [*t.lower().split(), lm.END]]
    assert sizes.tolist() == [4, 1, 1, 4] and flat.tolist() == [lm.word_hash(w) for w in want]
    words, at, sizes = lm.numbered(data)
    assert words[at].tolist() == flat.tolist() and sizes.tolist() == [4, 1, 1, 4] and len(set(words.tolist())) == len(words) == len(set(want))
