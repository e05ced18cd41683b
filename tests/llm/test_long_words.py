"""Mined terms count in words of any length, and long words are not held for the next text."""

from loomgrain.llm import toxicity


def test_long_words_have_terms():
    word = "grumbold" + "x" * 60
    assert {"gru@1", "grumbol@1", f"{word}$@1"} <= set(toxicity.terms_of({word}))
    assert "gru@2" in toxicity.terms_of({word, "grumps"})


def test_reader_finds_terms_in_long_words():
    reader = toxicity.Reader(["grumb@1", "grumb@2", "other$@1"])
    assert reader.read("a grumbold word")[1] == [0]
    assert reader.read("a grumbold" + "x" * 60 + " word")[1] == [0]
    assert reader.read("grumbold" + "x" * 6000 + " and GRUMBLER")[1] == [0, 1]
    assert reader.read("grumbold" + "x" * 60)[2][1] > 0
    assert all(len(word) <= toxicity.LONGEST for word in reader.known)
