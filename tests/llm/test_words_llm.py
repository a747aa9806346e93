import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm.words import PLAIN, SPACED, whole_hashes, window_hashes, words_of

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\x0b\x1f\x85é世🙂Z.1", max_size=40)),
                 min_size=1, max_size=5)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    data = [None if t is None else t.encode() for t in texts]
    for pattern, kind, lower in ((r"[^\x20\x09-\x0D]+", SPACED, False),
                                 (r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", PLAIN, True)):
        words = words_of(data, kind, lower)
        for i, text in enumerate(texts):
            text = (text or "").translate(LOWER) if lower else text or ""
            own = [words.word(j).decode() for j in range(words.first[i], words.first[i + 1])]
            assert own == re.findall(pattern, text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "ba", "é"]), max_size=30), st.integers(1, 6))
def test_equal_windows_have_equal_hashes_and_others_do_not(words, n):
    data = words_of([" ".join(words).encode()])
    hashes = window_hashes(data.hashes, n)
    windows = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    assert len(hashes) == len(windows)
    assert len(set(hashes.tolist())) == len(set(windows))
    assert {w: h for w, h in zip(windows, hashes, strict=True)} == dict(zip(windows, hashes, strict=True))


def test_hashes_do_not_depend_on_place_or_block(monkeypatch):
    text = ("one two " * 5000).encode()
    whole = words_of([b"x " + text]).hashes
    monkeypatch.setattr("footfall.llm.words.BLOCK_BYTES", 64)
    small = words_of([b"x " + text]).hashes
    assert (whole == small).all() and len(set(whole[1::2].tolist())) == 1
    alone = words_of([b"a b c"])
    assert whole_hashes(alone)[0] == window_hashes(alone.hashes, 3)[0]
    assert len(np.unique(whole)) == 3
