"""Token ids of whole texts with a public tokenizer, memoised by word.

A BPE model encodes every word of its pre-tokenizer on its own. ``WordEncoder`` therefore
finds the words of a batch of texts with array operations, hands each *distinct* word
to the ``tokenizers`` library once per worker, and gathers the ids of all words. The
word rules are those of the two public files (GPT-2 style byte-level, and word-end BPE).
Texts with characters outside the Latin blocks, or holding a special token's string,
are encoded whole by the library instead; both ways give the library's ids exactly.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np

from quarterdeck.llm.common import ragged_arange

LETTER, NUMBER, OTHER, SPACE, FOREIGN = 1, 2, 3, 4, 9
PLAIN_END = 0x180
#: Letters whose lower case or white-space class differs between libraries.
UNSURE = {0x85, 0xA0, 0x130, 0x149, 0x17F}
#: Words kept by a worker before it starts anew (about 100 bytes each).
MEMO_WORDS = 600_000


def _classes() -> np.ndarray:
    out = np.full(PLAIN_END + 1, FOREIGN, np.uint8)
    for cp in range(0x20, PLAIN_END):
        kind = unicodedata.category(chr(cp))
        if kind[0] != "C" and cp not in UNSURE:
            out[cp] = LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER
    for cp in (0x09, 0x0A, 0x0D, 0x20):
        out[cp] = SPACE
    return out


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts as one array with bounds; equal to ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.word_ends = bool(spec["model"].get("end_of_word_suffix"))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.classes = _classes()
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        hidden = [b for b in range(0x100) if b not in shown]
        self.alphabet = {b: chr(0x100 + i) for i, b in enumerate(hidden)}
        rng = np.random.default_rng(20240229)
        self.codes = rng.integers(1, 2**63, PLAIN_END + 1, dtype=np.uint64) | np.uint64(1)
        self.base = int(rng.integers(1, 2**62)) * 2 + 1
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers))
            for name, step in (("powers", self.base), ("inverse", pow(self.base, -1, 2**64))):
                full = np.full(size, np.uint64(step))
                full[0] = 1
                setattr(self, name, np.cumprod(full, dtype=np.uint64))

    def _words(self, cp: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every word; ``edge`` marks the first character of each text (and the end)."""
        n = len(cp)
        kind = self.classes[cp]
        new = np.empty(n + 1, bool)
        new[0] = new[n] = True
        new[1:n] = kind[1:] != kind[:-1]
        new |= edge
        # An apostrophe that forms a run of its own may open a contraction.
        pad = np.concatenate([cp, np.zeros(3, cp.dtype)])
        mark = np.flatnonzero((cp == 0x27) & new[:n] & new[1:])
        if len(mark):
            if not self.word_ends:
                mark = mark[edge[mark] | (pad[mark - 1] != 0x20)]
            mark = mark[~edge[mark + 1]]
            after, then = pad[mark + 1], pad[mark + 2]
            one = np.isin(after, [0x73, 0x74, 0x6D, 0x64])
            two = ((after == 0x72) | (after == 0x76)) & (then == 0x65) | (after == 0x6C) & (then == 0x6C)
            two &= ~edge[np.minimum(mark + 2, n)]
            size = np.where(one, 1, np.where(two, 2, 0))
            mark, size = mark[size > 0], size[size > 0]
            new[mark + 1] = False
            new[mark + size + 1] = True
        if self.word_ends:
            new[:n] |= kind == NUMBER
            start = np.flatnonzero(new[:n])
            end = np.append(start[1:], n)
            real = kind[start] != SPACE
            return start[real], end[real]
        # A run of white space gives its last character up: a space joins the word after it.
        space = kind == SPACE
        last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:n]) if n > 1 else np.zeros(0, np.int64)
        new[last] = True
        blank = last[cp[last] == 0x20]
        new[blank + 1] = False
        start = np.flatnonzero(new[:n])
        return start, np.append(start[1:], n)

    def _known(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return at

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        bpe = self.tokenizer.model.tokenize  # a word needs the BPE model only, on the byte-level alphabet
        got = [[t.id for t in bpe(w.encode().decode("latin-1").translate(self.alphabet))] for w in words]
        count = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((i for ids in got for i in ids), np.uint32, int(count.sum()))
        first = np.cumsum(count) - count + len(self.ids)
        self.ids = np.concatenate([self.ids, flat])
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.keys = np.concatenate([self.keys, keys])[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        joined = "".join(texts)
        if self.word_ends:
            joined = joined.lower()
        cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        n = len(cp)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        edge = np.zeros(n + 1, bool)
        edge[bounds] = True
        start, end = self._words(cp, edge)
        self._grow(n + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.codes[cp] * self.powers[:n], dtype=np.uint64)])
        keys = (sums[end] - sums[start]) * self.inverse[start]
        distinct, at, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > MEMO_WORDS:
            self._forget()
        known = self._known(distinct)
        fresh = np.flatnonzero(self.keys[known] != distinct) if len(self.keys) else np.arange(len(distinct))
        if len(fresh):
            self._learn(distinct[fresh], [joined[start[i] : end[i]] for i in at[fresh]])
            known = self._known(distinct)
        of_word = known[back]
        count = self.count[of_word]
        ids = self.ids[np.repeat(self.first[of_word], count) + ragged_arange(count)]
        total = np.concatenate([[0], np.cumsum(count)])
        per_text = total[np.searchsorted(start, bounds[1:])] - total[np.searchsorted(start, bounds[:-1])]
        return ids, per_text

    def _is_plain(self, text: str) -> bool:
        if text.isascii() and text.isprintable():
            return True
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return bool((self.classes[np.minimum(cp, PLAIN_END)] != FOREIGN).all())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as an array of unsigned 32-bit integers."""
        plain = [self._is_plain(t) and not ("<" in t and any(s in t for s in self.special)) for t in texts]
        ids, counts = self._plain([t for t, p in zip(texts, plain, strict=True) if p])
        ends = np.cumsum(counts)
        own = iter(np.split(ids, ends[:-1])) if len(counts) else iter(())
        whole = iter(self.tokenizer.encode_batch_fast([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [next(own) if p else np.array(next(whole).ids, np.uint32) for p in plain]


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker and file."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordEncoder(path)
