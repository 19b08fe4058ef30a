"""Content-chosen anchors in byte strings: every ``width`` bytes hold one, chosen by those bytes alone.

An anchor is the place of the smallest hash of ``GRAM`` bytes in a window (the last one, if equal). Equal windows have
their anchor at the same offset, so windows that repeat share an anchor's bytes.
"""

from __future__ import annotations

import numpy as np

from quarterdeck.llm.shingles import scramble

GRAM = 64
_BYTES = np.random.default_rng(31).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x2545F4914F6CDD1D
_PLACE_BITS = 24
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)


class Hasher:
    """Polynomial hashes, modulo 2**64, of any stretch of a byte string."""

    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(data):
            for name, step in (("powers", _BASE), ("inverse", pow(_BASE, -1, 2**64))):
                full = np.full(2 * len(data) + 2, np.uint64(step))
                full[0] = 1
                setattr(self, name, np.cumprod(full, dtype=np.uint64))
        return np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[data] * self.powers[: len(data)], dtype=np.uint64)])

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((sums[end] - sums[start]) * self.inverse[start])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, in linear time by blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], width: int, hasher: Hasher) -> tuple[np.ndarray, ...]:
    """Of every anchor: its text's place, hash, place in the text, first window start that chose it, and how many did.

    An anchor's hash is the smallest of many, so it is scrambled once more: all its bits are even again, as bitmaps need.
    The starts of a text's windows are divided among its anchors. Texts shorter than ``width`` have none. A text
    may be of any length: hashes' places are compared within a window only.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not (sizes >= width).any():
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))
    sums = hasher.sums(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = hasher.of(sums, at, at + GRAM)
    held = (grams & ~_PLACE) | (_PLACE - (at.astype(np.uint64) & _PLACE))
    least = sliding_min(held, width - GRAM + 1)
    n = len(least)
    # A window lies in one text if it starts at least ``width`` bytes before the text's end.
    ok = np.zeros(len(data) + 1, np.int8)
    long = sizes >= width
    ok[begins[long]] = 1
    ok[(begins + sizes - width + 1)[long]] -= 1
    start = np.flatnonzero(np.cumsum(ok[:-1])[:n] > 0)
    place = (_PLACE - (least[start] & _PLACE)).astype(np.int64)
    place += (start >> _PLACE_BITS) << _PLACE_BITS
    place[place < start] += 1 << _PLACE_BITS
    of = np.searchsorted(begins, start, side="right") - 1
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (of[1:] != of[:-1])]))
    count = np.diff(np.append(new, len(start)))
    of, first, spot = of[new], start[new], place[new]
    return of, scramble(grams[spot]), spot - begins[of], first - begins[of], count
