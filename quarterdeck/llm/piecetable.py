"""SentencePiece encoding and decoding by a merge-type prefix table.

A BPE model of SentencePiece starts from single characters and keeps merging the neighbours whose joint string has the best
score, the leftmost of equals first. ``PieceTable`` gets the same ids in one pass over the text:

* What merges do inside a stretch of text depends on that stretch alone until a merge crosses its border. So a sequence of
  pieces is the model's answer exactly if each piece is what its own string encodes to and each two neighbours are what their
  joint string encodes to ("compatible"), and the answer for a prefix of the text is a prefix of such a sequence. Hence each
  prefix has exactly one last piece.
* An Aho-Corasick automaton finds the pieces that end at each character. The one that is compatible with the last piece of
  the prefix before it is stored; the ids are then read backwards from the end.
* Two pieces are compatible if no merge across their border is ever the best one while both grow: their own merges, each in
  its order, are gone through side by side.

No piece reaches from a character into a following blank, nor holds letters and other characters at once (both are tested on the
model; ``CUTS``), so a text is cut there and every distinct part is encoded once per task (``MEMO`` parts and as many pairs are
remembered, then forgotten all at once); a long part is not remembered but takes time in proportion to its length. Characters without a piece become their UTF-8 bytes' ids.

Scale: one pass over the documents without a shuffle; the model is a file on every executor; nothing is broadcast or collected.

Defined cases: a null text is empty; an empty text has no ids and decodes to an empty text; rows are kept as they are, repeated
ones and null ids included; a text of any length is encoded whole; other columns are not read. Equal scores go to the leftmost merge, as
in the library. A model of another kind (not BPE, no byte fallback, another normaliser, pieces given by its user) is refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import batch_of, table, text_or_empty, text_slices
from quarterdeck.llm.tokens import default_path

BLANK = "▁"  # how SentencePiece writes a space
MEMO, MEMO_LENGTH = 250_000, 48
NEVER = float("inf")


def _ranges(points: Iterable[int]) -> str:
    """Ascending code points as ranges of a pattern's class."""
    out: list[list[int]] = []
    for c in points:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


#: Letters of the first plane, listed: such a class is looked up in a table. Others count as marks.
LETTERS = _ranges(c for c in range(0x10000) if chr(c).isalpha())
#: Where texts may be cut: every piece must match one of these patterns whole. First words, numbers and marks apart, then words.
CUTS = (
    re.compile(rf"{BLANK}*(?:[{LETTERS}]+|[^{LETTERS}{BLANK}]+)|{BLANK}+"),
    re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+"),
)


class Memo(dict):
    """What ``make`` gave for each key that was asked for, ``MEMO`` of them at most; then all are forgotten at once."""

    def __init__(self, make: Callable, kept: Callable = lambda key: True):
        self.make, self.kept = make, kept

    def __missing__(self, key):
        got = self.make(key)
        if self.kept(key):
            if len(self) >= MEMO:
                self.clear()
            self[key] = got
        return got


class PieceTable:
    """Ids of texts and texts of ids, equal to the library's ``encode`` and ``decode``."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        _refuse_other_kinds(model)
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.piece: list[str] = []
        self.byte: dict[int, int] = {}
        self.unknown = model.unk_id()
        self.automaton = ahocorasick.Automaton()
        for i in range(model.vocab_size()):
            text = model.id_to_piece(i)
            self.piece.append(text)
            if model.is_byte(i):
                self.byte[i] = int(text[1:-1], 16)
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.rank[text], self.id[text] = -model.get_score(i), i
                self.automaton.add_word(text, text)
        self.automaton.make_automaton()
        self.byte_id = {value: i for i, value in self.byte.items()}
        self.shown = {text: str(i) for text, i in self.id.items()}
        self.cuts = next((cut for cut in CUTS if all(cut.fullmatch(p) for p in self.id)), None)
        self.grown: dict[str, tuple | None] = {}
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, tuple[str, int, str]] = Memo(self._word, lambda part: len(part) <= MEMO_LENGTH)
        self.pairs: dict[tuple[str, str], bool] = Memo(self._compatible)

    def _grow(self, piece: str) -> tuple | None:
        """The piece's own merges as (rank, last symbol, first symbol) after each; None if merging its characters gives something else."""
        if piece in self.grown:
            return self.grown[piece]
        parts, steps = list(piece), [(NEVER, piece[-1], piece[0])]
        while len(parts) > 1:
            rank, at = min((self.rank.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((rank, parts[-1], parts[0]))
        own = tuple(steps) if len(parts) == 1 else None
        if piece in self.rank:  # characters without a piece are not remembered: there is no bound to their number
            self.grown[piece] = own
        return own

    def _compatible(self, pair: tuple[str, str]) -> bool:
        """Whether the joint string of two pieces encodes to these two; with nothing before it, whether a piece encodes to itself."""
        return self._apart(*pair) if pair[0] else self._grow(pair[1]) is not None

    def _apart(self, left: str, right: str) -> bool:
        a, b = self._grow(left), self._grow(right)
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            across = self.rank.get(a[i][1] + b[j][2], NEVER)
            next_a = a[i + 1][0] if i + 1 < len(a) else NEVER
            next_b = b[j + 1][0] if j + 1 < len(b) else NEVER
            if across < next_a and across <= next_b:  # a merge on the left of it goes first among equals, one on its right does not
                return False
            if next_a == next_b == NEVER:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def split(self, text: str) -> list[str]:
        """The pieces of a normalised text; a character without a piece stands for itself."""
        last, pairs, done = ["", *text], self.pairs, 0  # of every prefix: the character itself, unless a piece fits
        for end, piece in self.automaton.iter(text):
            end += 1
            if end != done and pairs[last[end - len(piece)], piece]:
                last[end], done = piece, end
        out, i = [], len(text)
        while i:
            out.append(last[i])
            i -= len(last[i])
        out.reverse()
        return out

    def _ids(self, part: str) -> list[int]:
        out: list[int] = []
        for piece in self.split(part):
            known = self.id.get(piece)
            out += [known] if known is not None else [self.byte_id[b] for b in piece.encode()]
        return out

    def _parts(self, text: str) -> list[str]:
        """A normalised text, cut where no piece can reach across."""
        if not text:
            return []
        shown = BLANK + text.replace(" ", BLANK)
        return self.cuts.findall(shown) if self.cuts else [shown]

    def _word(self, part: str) -> tuple[str, int, str]:
        """Decimal ids joined by commas, their number, and what they decode to inside a text."""
        pieces = self.split(part)
        try:  # all pieces have ids, which decode to the pieces themselves
            return ",".join([self.shown[p] for p in pieces]), len(pieces), "".join(pieces).replace(BLANK, " ")
        except KeyError:
            ids = self._ids(part)
            return ",".join(map(str, ids)), len(ids), self._text(ids)

    def _text(self, ids: Iterable[int]) -> str:
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte:
                run.append(self.byte[i])
                continue
            if run:
                out.append(characters(bytes(run)))
                run.clear()
            piece = self.piece[i]  # of control pieces nothing is shown
            out.append(" ⁇ " if i == self.unknown else piece.replace(BLANK, " ") if piece in self.id else "")
        return "".join(out) + characters(bytes(run))

    def encode(self, text: str) -> list[int]:
        return [i for part in self._parts(text) for i in self._ids(part)]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; the blank that encoding puts first is taken off again."""
        text = self._text(ids)
        first = next((i for i in ids if i in self.byte or i == self.unknown or self.piece[i] in self.id), None)
        return text[1:] if first is not None and self.piece[first].startswith(BLANK) else text

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, sha256 of the ids as decimal numbers joined by commas, sha256 of the text that they decode to."""
        words = list(map(self.words.__getitem__, self._parts(text)))
        ids, sizes, shown = zip(*words, strict=True) if words else ((), (), ())
        decoded = "".join(shown)[1:]  # the first word begins with the blank that encoding put there
        return sum(sizes), hashlib.sha256(",".join(ids).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def characters(run: bytes) -> str:
    """Bytes as UTF-8; each byte that begins no character becomes U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(run):
        for size in range(1, 5):
            try:
                out.append(run[i : i + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        i += size
    return "".join(out)


def _refuse_other_kinds(model) -> None:
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model.serialized_model_proto())
    rules, training = spec.normalizer_spec, spec.trainer_spec
    kinds = type(spec).SentencePiece
    usual = {kinds.NORMAL, kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN}
    if training.model_type != training.BPE or not training.byte_fallback or {p.type for p in spec.pieces} - usual:
        raise ValueError("a BPE model with byte fallback and no pieces given by its user is needed")
    plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
    if rules.precompiled_charsmap or not plain or training.treat_whitespace_as_suffix:
        raise ValueError("a model that takes texts as they are, with a blank put before them, is needed")


@lru_cache(1)
def loaded(path: str) -> PieceTable:
    return PieceTable(path)


def piece_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, by the model file at ``path`` on every executor."""
    path = path or default_path("piece_bpe_32k.model")
    kinds = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        pieces = loaded(path)
        for batch in text_slices(batches, 1):
            found = [pieces.digest(text) for text in batch.column(1).to_pylist()]
            yield batch_of(kinds, [batch.column(0), *zip(*found, strict=True)] if found else [[], [], [], []])
        pieces.forget()  # a worker's next task may be another stage's

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))
