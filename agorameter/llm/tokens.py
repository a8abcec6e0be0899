"""Ids of the lower-casing word BPE, from its tokenizer, with each distinct word encoded once.

The tokenizer normalises, splits into words and merges inside a word, so the ids of a word do
not depend on its neighbours. For texts in the letters checked below, the split is repeated
here and the words are looked up; all other texts go through the tokenizer whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from pathlib import Path

import numpy as np

#: Characters below are composed, have a lower case of their own or none, and no special space.
LIMIT = 0x180
#: Separators that Python takes for white space and the tokenizer does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"
SPECIAL = "<|"
BEYOND = re.compile(f"[{chr(LIMIT)}-\U0010ffff]")
#: The settings for which the split is valid, fixed values of the vocabulary file.
NORMALIZER = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Most entries of a generation of the cache, some 20 MB in a worker that later stages use too.
#: A full one becomes the older generation, whose
#: entries move back when they are met again.
ENTRIES = 100_000
#: Longer words are not kept.
LONGEST = 64


def _class(letter: str) -> str:
    """The characters of a general category below the limit, for a character class."""
    found = (chr(c) for c in range(LIMIT) if unicodedata.category(chr(c))[0] == letter)
    return "".join(map(re.escape, found))


def _byte_characters() -> str:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


class WordBpe:
    """Encoder of one worker; ``encode`` gives little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(Path(path).read_text())
        normalizers = [x["type"] for x in (settings["normalizer"] or {}).get("normalizers", [])]
        splits = [
            x["pattern"].get("Regex")
            for x in (settings["pre_tokenizer"] or {}).get("pretokenizers", [])
            if x["type"] == "Split"
        ]
        self.by_word = normalizers == NORMALIZER and splits == [PATTERN]
        letters, numbers = _class("L"), _class("N")
        self.split = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+"
        )
        self.names = _byte_characters()
        self.packed = [
            i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))
        ]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if not self.by_word or not _plain(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        known = self.known.get
        return b"".join([known(c) or self._chunk(c) for c in text.lower().split()])

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a stretch without white space; its words are chunks too."""
        ids = self.older.get(chunk)
        if ids is None:
            words = self.split.findall(chunk)
            if len(words) == 1:
                ids = self._word(chunk)
            else:
                known = self.known.get
                ids = b"".join([known(w) or self._chunk(w) for w in words])
        if len(chunk) <= LONGEST:
            if len(self.known) >= ENTRIES:
                self.older, self.known = self.known, {}
            self.known[chunk] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):
            word = "".join([self.names[b] for b in word.encode()])
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenizer.model.tokenize(word)])


def _plain(text: str) -> bool:
    """Whether the split into words is repeated exactly for this text."""
    if SPECIAL in text or any(c in text for c in SEPARATORS):
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return BEYOND.search(text) is None
    return True


_ENCODERS: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """The encoder of this worker, made once per vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordBpe(path)
    return _ENCODERS[path]
