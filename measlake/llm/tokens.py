"""Token ids of texts, by a tokenizer file."""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

# The settings under which words can be encoded one by one.
WORD_NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
WORD_END = "</w>"

# Texts of these characters alone are already in NFC, and lower case is a matter of each character.
PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
LETTERS = "a-zß-öø-ÿ"
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s{LETTERS}0-9]+")
KEPT_WORDS = 300_000


class Encoder:
    """Encodes texts, remembering the ids of recent words if the tokenizer works by words.

    Holds two generations of at most ``KEPT_WORDS`` words each, whatever it has read.
    """

    def __init__(self, path: str) -> None:
        # Tasks share the cores already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        before = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (
            (settings.get("normalizer") or {}).get("normalizers") == WORD_NORMALIZER
            and before[0].get("pattern") == {"Regex": WORD_SPLIT}
            and settings["model"].get("end_of_word_suffix") == WORD_END
        )
        special = [re.escape(t["content"]) for t in settings.get("added_tokens") or []]
        self.special = re.compile("|".join(special)) if special else None
        if self.by_word:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        ids = np.array(
            self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, dtype="<u4"
        )
        cuts = np.flatnonzero(self.ends[ids]) + 1 if len(ids) else []
        if len(cuts) == len(words):
            data, last = ids.tobytes(), 0
            for word, cut in zip(words, (4 * cuts).tolist()):
                self.new[word] = data[last:cut]
                last = cut
        else:
            self.new.update((word, self.whole(word)) for word in words)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        parts: list[list[str] | None] = []
        for text in texts:
            plain = (
                self.by_word
                and PLAIN.fullmatch(text)
                and not (self.special and self.special.search(text))
            )
            parts.append(PARTS.findall(text.lower()) if plain else None)
        if len(self.new) > KEPT_WORDS:
            self.new, self.old = {}, self.new
        missing = set().union(*filter(None, parts)).difference(self.new)
        fresh = []
        for word in missing:
            if (ids := self.old.get(word)) is not None:
                self.new[word] = ids
            else:
                fresh.append(word)
        for i in range(0, len(fresh), 10_000):
            self.learn(fresh[i : i + 10_000])
        known = self.new.__getitem__
        return [
            self.whole(text) if words is None else b"".join(map(known, words))
            for text, words in zip(texts, parts)
        ]


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker process, so that tasks which follow each other share its words."""
    return Encoder(path)
