"""Hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np

SLICE = 1 << 20
PRIME = 0x100000001B3
INVERSE = pow(PRIME, -1, 1 << 64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def kinds_of(*groups: str) -> np.ndarray:
    """Kind of each byte: 0 between words, else the number of its group; beyond ASCII, group 1."""
    kinds = np.zeros(256, dtype=np.int8)
    for number, group in enumerate(groups, start=1):
        for sign in group:
            kinds[ord(sign)] = number
    kinds[128:] = 1
    return kinds


def powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class Words:
    """Words are runs of bytes of one kind; their hashes come from one running sum.

    Slices of a megabyte are hashed at once, cut between words; a longer word is hashed
    piece by piece, and stays one word.
    """

    def __init__(self, kinds: np.ndarray) -> None:
        self.kinds = kinds
        self.up, self.down = powers(PRIME, SLICE + 1), powers(INVERSE, SLICE + 1)

    def slice(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and hash of each word."""
        kinds = self.kinds[data]
        starts = np.flatnonzero(np.diff(kinds, prepend=-1))
        ends = np.append(starts[1:], len(data))
        word = kinds[starts] > 0
        starts, ends = starts[word], ends[word]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        mixed = (sums[ends] - sums[starts]) * self.down[starts]
        return starts, (mixed ^ (mixed >> np.uint64(32))) * MIX

    def long(self, data: np.ndarray, first: int) -> tuple[int, np.ndarray]:
        """End and hash of the word that begins at ``first``, of any length."""
        kind, at, total = self.kinds[data[first]], first, 0
        while at < len(data):
            part = data[at : at + SLICE]
            others = np.flatnonzero(self.kinds[part] != kind)
            part = part[: others[0]] if len(others) else part
            own = (part.astype(np.uint64) + np.uint64(1)) * self.up[: len(part)]
            total = (total + int(own.sum()) * pow(PRIME, at - first, 1 << 64)) % (1 << 64)
            at += len(part)
            if len(others):
                break
        mixed = np.array([total], dtype=np.uint64)
        return at, (mixed ^ (mixed >> np.uint64(32))) * MIX

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and the first word of each text (and the end)."""
        data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        starts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        first = 0
        while first < len(data):
            end = min(first + SLICE, len(data))
            if end < len(data):
                changes = np.flatnonzero(np.diff(self.kinds[data[first:end]]))
                if len(changes):
                    end = first + int(changes[-1]) + 1
                elif self.kinds[data[first]] > 0:
                    end, own = self.long(data, first)
                    starts.append(np.array([first]))
                    hashes.append(own)
                    first = end
                    continue
            found, own = self.slice(data[first:end])
            starts.append(found + first)
            hashes.append(own)
            first = end
        return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), begins)
