"""Word shingles of many texts at a time, as arrays of 64-bit hashes.

Words are runs of ASCII letters and digits and of any non-ASCII characters, in lower case. A text of fewer words than a
shingle has one shingle of all its words; a text without words has none.
"""

from __future__ import annotations

import hashlib

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(17).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x2545F4914F6CDD1D
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    def __init__(self, size: int = 5):
        self.size, self.powers, self.inverse = size, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The text's place and the hash of every word, in order."""
        raw = [t.lower().encode() for t in texts]
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        inside = np.concatenate([[False], _IN_WORD[data]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[0::2], edge[1::2]
        if len(self.powers) < len(data):
            for name, step in (("powers", _BASE), ("inverse", pow(_BASE, -1, 2**64))):
                full = np.full(2 * len(data), np.uint64(step))
                full[0] = 1
                setattr(self, name, np.cumprod(full, dtype=np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[data] * self.powers[: len(data)], dtype=np.uint64)])
        return np.searchsorted(ends, start, side="right"), scramble((sums[end] - sums[start]) * self.inverse[start])

    def shingles(self, doc: np.ndarray, words: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """The text's place and the hash of every shingle, repeats included."""
        count = np.bincount(doc, minlength=texts)
        left = np.cumsum(count)[doc] - np.arange(len(words))  # words from here to the text's end
        out = words.copy()
        for k in range(1, self.size):
            more = np.flatnonzero(left > k)
            out[more] = scramble(out[more] * MIX + words[more + k])
        kept = (left >= self.size) | ((left == count[doc]) & (count[doc] < self.size))
        return doc[kept], out[kept]

    def counted(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Place, hash and number of every distinct shingle of each text, by place and hash; a key of each text's words."""
        doc, words = self.words(texts)
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        keys = []
        for i, text in enumerate(texts):
            own = words[bounds[i] : bounds[i + 1]].tobytes()
            keys.append(hashlib.blake2b(own or text.encode(), digest_size=16, person=b"words" if own else b"text").digest())
        place, shingle = self.shingles(doc, words, len(texts))
        order = np.lexsort((shingle, place))
        place, shingle = place[order], shingle[order]
        if not len(place):
            return place, shingle, np.zeros(0, np.int64), keys
        first = np.flatnonzero(np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (place[1:] != place[:-1])]))
        return place[first], shingle[first], np.diff(np.append(first, len(place))), keys
