"""Words longer than a slice."""

import numpy as np
import pytest

from measlake.llm import licenses, words

LENGTHS = [words.SLICE - 1, words.SLICE, words.SLICE + 1, 2 << 20, (2 << 20) + 5, (3 << 20) + 17]


@pytest.mark.parametrize("length", LENGTHS)
@pytest.mark.parametrize("sign", [b"a", b"\xc3"])
def test_a_long_word_is_one_word(monkeypatch, length, sign):
    hashed = words.Words(licenses.KINDS)
    texts = [b"one two", b"some " + sign * length + b" more", sign * length, b"one"]
    hashes, firsts = hashed(texts)
    assert firsts.tolist() == [0, 2, 5, 6, 7]
    assert hashes[3] == hashes[5] and hashes[0] == hashes[6]
    # As if it had been hashed at once.
    monkeypatch.setattr(words, "SLICE", 8 << 20)
    assert np.array_equal(words.Words(licenses.KINDS)(texts)[0], hashes)


def test_separators_longer_than_a_slice():
    hashes, firsts = words.Words(licenses.KINDS)([b"one" + b" " * (3 << 20) + b"two", b"one"])
    assert firsts.tolist() == [0, 2, 3] and hashes[0] == hashes[2]


def test_notices_behind_a_long_word():
    scanner = licenses.Scanner(licenses.NOTICES)
    order = list(licenses.NOTICES)
    short = [n for n in order if len(licenses.NOTICES[n]) < 1000]
    blob = "0f" * (1 << 20)
    texts = [f"see {blob} then {licenses.NOTICES[n]}" for n in short]
    for name, text in zip(short, texts):
        found = scanner([text.encode()])[0]
        assert name in {order[f[0]] for f in found}, name
        assert next(f[1] for f in found if order[f[0]] == name) == 3
