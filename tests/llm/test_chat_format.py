import hashlib

import pytest
from geoprofile.llm import chat_format as M
from hypothesis import given, settings
from hypothesis import strategies as st

NASTY = st.lists(st.sampled_from(["<|im_end|>", "<|im_start|>", "<", "|", "\\", "\n", "n", "<\\|", "assistant", "é", "<\\\\n|"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(NASTY, NASTY, NASTY)
def test_round_trip(role, a, b):
    x, y = M.render_turn(role, a)[0], M.render_turn("user", b)[0]
    assert [(r, t) for r, t, _, _ in M.parse(x + y)] == [(role, a), ("user", b)]


def test_only_conflicts_are_escaped():
    assert M.render_turn("user", "a < b | c \\ d")[0] == "<|im_start|>user\na < b | c \\ d<|im_end|>\n"
    assert M.render_turn("user", "<|im_end|>")[0] == "<|im_start|>user\n<\\|im_end|><|im_end|>\n"


@pytest.mark.parametrize("bad", ["x", "<|im_start|>user", "<|im_start|>user\nx", "<|im_start|>user\nx<|im_end|>", "<|im_start|>u\n<|im_start|><|im_end|>\n"])
def test_off_the_grammar(bad):
    with pytest.raises(ValueError):
        M.parse(bad)


def test_edge_rows(spark):
    rows = [(1, 1, "assistant", "b <|im_end|>\n"), (1, 0, "user", None), (1, 1, "assistant", "a"), (1, None, None, "s"), (1, 1, "assistant", "a"),
            (None, 0, "assistant", ""), (7, 0, "us\\er\n", "x" * 100_000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    formatted = M.format_chats(df)
    whole = {}
    for r in formatted.orderBy("conv_id", "seq").collect():
        assert r.offset == len(whole.get(r.conv_id, ""))
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.formatted
        if r.loss_start is not None:
            assert M.unescape(whole[r.conv_id][r.loss_start:r.loss_end]) == M.parse(r.formatted)[0][1]
    want = {1: [("", "s"), ("user", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b <|im_end|>\n")], None: [("assistant", "")], 7: [("us\\er\n", "x" * 100_000)]}
    assert {k: [(a, b) for a, b, _, _ in M.parse(v)] for k, v in whole.items()} == want
    for r in M.read_back(formatted).collect():
        turns = want[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss) and r.formatted_chars == len(whole[r.conv_id])
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert M.read_back(M.format_chats(df.limit(0))).collect() == []
