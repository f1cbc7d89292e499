from geoprofile.llm import quality as M

VARIETY = [h[0] for h in M.HEURISTICS].index("variety")


def voted(text):
    return M.vote(M.measures(text, {})[0])[VARIETY]


def test_variety_covers_the_whole_text():
    rich, poor = [f"w{i}" for i in range(400)], ["a", "b", "c", "d"] * 100
    assert voted(" ".join(rich * 3)) == "+" and voted(" ".join(poor * 3)) == "-"
    assert voted(" ".join(rich + poor * 9)) == "-"  # begins well, then recycles a small vocabulary
    assert voted(" ".join(poor + rich * 9)) == "+"
    assert M.variety(rich + poor[:200], 404) == (1 + (200 + 4) / 400) / 2  # the last block ends with the text
    assert M.variety(rich, 400) == 1 and M.variety(rich[:10] * 2, 10) == 0.5


def test_all_shapes_are_features():
    text = " ".join("aA9-"[i % 4] + "".join("a9"[i >> k & 1] + "-" for k in range(6)) for i in range(64))
    m, shapes = M.measures(text, {})
    assert len(shapes) > 40 and sum(f.startswith("shape:") for f in M.features(m, shapes)) == len(shapes)


def test_the_end_of_a_long_word_counts():
    a, b = "a-" * 40, "a-" * 40 + "9"
    assert M.word_facts(a)[0] != M.word_facts(b)[0] and len(M.word_facts(b)[0]) <= M.SHAPE + 3
