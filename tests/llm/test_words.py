from __future__ import annotations

import random
import re

from agorameter.llm import words
from agorameter.llm.words import LOWER, SPACES, window_hashes, word_hashes


def test_equal_words_and_only_those_have_equal_hashes(monkeypatch):
    chance = random.Random(4)
    names = ["a", "A", "b", "ab", "ba", "é", "\x1c", "\x85x", "\xa0", "x" * 30, "aa", "aaa", "\x00"]
    text = "".join(chance.choice(names) + chance.choice([" ", "\t", "\n \r", "\v\f"]) for _ in range(500))
    found = re.findall("[^\x20\x09-\x0d]+", text)
    whole = word_hashes(text.encode())
    assert len(whole) == len(found)
    assert len(set(zip(whole.tolist(), found))) == len(set(found)) == len(set(whole.tolist()))
    monkeypatch.setattr(words, "STRETCH", 16)  # the longer word is hashed by itself
    short = word_hashes(text.encode()).tolist()
    assert len(set(zip(short, found))) == len(set(found)) == len(set(short))
    alone = {w: word_hashes(w.encode())[0] for w in set(found)}
    assert short == [alone[w] for w in found]


def test_lower_case():
    assert (word_hashes("AbC É".encode(), LOWER) == word_hashes("abc É".encode(), SPACES)).all()


def test_windows():
    chance = random.Random(6)
    text = [chance.choice("abc") for _ in range(400)]
    hashed = word_hashes(" ".join(text).encode())
    for size in (1, 3, 5, 8):
        windows = [tuple(text[i : i + size]) for i in range(len(text) - size + 1)]
        keys = window_hashes(hashed, size).tolist()
        assert len(set(zip(keys, windows))) == len(set(windows)) == len(set(keys))
    assert len(window_hashes(hashed[:2], 3)) == 0 and len(word_hashes(b"")) == 0
    assert len(word_hashes(b" \n ")) == 0
