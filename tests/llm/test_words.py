import numpy as np

from bayline.llm.words import SLICE, Words, slices


def test_a_long_word_is_one_word():
    long = "ab" * 300_000
    hashes, number = Words()(["x " + long, "x yy " * 3 + long + "\rz", long])
    assert number.tolist() == [2, 8, 1]
    assert hashes[1] == hashes[8] == hashes[10] and len(set(hashes.tolist())) == 4


def test_every_white_space_separates_slices():
    words = [f"w{i}" for i in range(200_000)]
    want, number = Words()([" ".join(words)])
    assert number.tolist() == [200_000]
    for blank in "\t\n\v\f\r":
        text = blank.join(words)
        parts = list(slices(text))
        assert "".join(parts) == text and max(map(len, parts)) < SLICE + 10
        found, number = Words()([text])
        assert number.tolist() == [200_000] and np.array_equal(found, want)
