"""Operator 11 against the library, text by text."""

import hashlib
import random

import pytest
import sentencepiece
from quarterdeck.llm.piecetable import PieceTable, characters, piece_digests
from quarterdeck.llm.tokens import default_path

PATH = default_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return PieceTable(PATH)


def expected(library, text):
    ids = library.encode(text or "")
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
    return (len(ids), *sha)


def test_ids_and_texts_equal_the_library(library, pieces):
    rng = random.Random(8)
    alphabet = "abcdeiot nrsING  \n\t▁éß½²中文0123<>/sx.,'\x00😀ाα"
    for size in (3, 8, 40):
        for _ in range(1500):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(size + 1)))
            ids = pieces.encode(text)
            assert ids == library.encode(text), repr(text)
            assert pieces.decode(ids) == library.decode(ids), repr(text)
            assert pieces.digest(text) == expected(library, text)


@pytest.mark.parametrize(
    "text",
    ["", " ", "   ", "▁", "▁a", "<s>", "<0x41>", "<unk></s>", "ééé", "a" * 5000, " " * 100, "thethethe" * 700, "\U0010ffff", "🏳️‍🌈", "x\r\ny", "²."],
)
def test_odd_texts(library, pieces, text):
    assert pieces.encode(text) == library.encode(text)
    assert pieces.decode(pieces.encode(text)) == library.decode(library.encode(text))


def test_any_ids_decode_as_in_the_library(library, pieces):
    rng = random.Random(9)
    for _ in range(4000):
        ids = [rng.choice((rng.randrange(32000), rng.randrange(300))) for _ in range(rng.randrange(8))]
        assert pieces.decode(ids) == library.decode(ids), ids


def test_pieces_that_overlap_in_a_long_word_stay_exact(library, pieces):
    rng = random.Random(10)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(60_000))
    assert pieces.encode(word) == library.encode(word)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("quarterdeck.llm.piecetable.MEMO", 3)
    small = PieceTable(PATH)
    text = "several words, several words and 12 words more ééé ñ 中 of several kinds"
    assert [small.digest(text) for _ in range(3)] == [expected(library, text)] * 3
    assert len(small.words) <= 3 and len(small.pairs) <= 3


def test_broken_bytes():
    assert characters(b"\xc3\xa9\xff\xe4\xb8") == "é���"


def test_query_on_odd_rows(library, odd_docs, odd_rows):
    got = piece_digests(odd_docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = [(r[0], *expected(library, r[1])) for r in odd_rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_query_on_an_empty_table(no_docs):
    assert piece_digests(no_docs, PATH).count() == 0


def test_a_known_pair_or_first_piece_is_not_tested_again(library, monkeypatch):
    table = PieceTable(PATH)
    text = "several undecided words, désolé 中文 of 12 kinds"
    ids = table.encode(text)
    monkeypatch.setattr(table, "_grow", None)
    assert table.encode(text) == ids == library.encode(text)
