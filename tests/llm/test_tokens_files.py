"""Token ids, packing, token files: against the tokenizers library and exact round trips."""

import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from quarterdeck.llm import packing, tokenfile
from quarterdeck.llm.tokens import default_path, encoder
from quarterdeck.plans.storage import staging_path


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_encoder_equals_the_library(name, odd_rows):
    rng = random.Random(1)
    alphabet = " \n\t'''stmdrevelabéÉ12²!.,_<|ªŒİ中x́\r"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["", " ", "it's we'll 've 're", "  a  b  ", " 's", "''s", "<|endoftext|>x"] + [r[1] or "" for r in odd_rows]
    own = encoder(default_path(name))
    whole = own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    got = [ids for i in range(0, len(texts), 500) for ids in own.encode(texts[i : i + 500])]
    assert [list(g) for g in got] == [w.ids for w in whole]


def ids_of(name, text, end_id=2):
    return np.array([*encoder(default_path(name)).tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")


def test_piece_lengths():
    for n in range(1, 300):
        got = packing.piece_lengths(n, 64)
        assert sum(got) == n and all(x & (x - 1) == 0 and x <= 64 for x in got) and got == sorted(got, reverse=True)


def test_packing_covers_every_id_once(odd_docs, odd_rows):
    out = packing.pack(odd_docs, limit=64, keep_ids=True).collect()
    assert sorted(r.sequence_id for r in out) == list(range(len(out))) and {r.offset for r in out} == {0}
    assert [r.length for r in sorted(out, key=lambda r: r.sequence_id)] == sorted((r.length for r in out), reverse=True)
    got = {}
    for r in out:
        assert crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        got.setdefault(r.doc_id, {}).setdefault(r.doc_tokens, []).append((r.start, bytes(r.ids)))
    for doc_id, text, *_ in odd_rows:
        ids = ids_of(packing.TOKENIZER, text)
        pieces = got[doc_id][len(ids)]
        same = sum(1 for d, t, *_ in odd_rows if d == doc_id and len(ids_of(packing.TOKENIZER, t)) == len(ids))
        assert len(pieces) == same * len(packing.piece_lengths(len(ids), 64))
        assert {(s, ids[s : s + len(p) // 4].tobytes()) for s, p in pieces} == set(pieces) or same > 1


def test_packing_encodes_little_text_together(monkeypatch):
    own, asked = encoder(default_path(packing.TOKENIZER)), []

    class Asked:
        def encode(self, texts):
            asked.append(texts)
            return own.encode(texts)

    class Task:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(packing, "encoder", lambda path: Asked())
    monkeypatch.setattr(packing.TaskContext, "get", lambda: Task)
    texts = ["word " * 10_000] * 30 + ["long " * 100_000, None, ""]  # 50 KB each, one of 500 KB
    batch = pa.RecordBatch.from_arrays([pa.array(range(33), pa.int64()), pa.array([t or "" for t in texts])], names=["doc_id", "text"])
    run, _ = packing._pieces("", 4096, 2, False)
    rows = [r for b in run([batch]) for r in b.to_pylist()]
    assert sum(r["length"] for r in rows) == sum(len(ids_of(packing.TOKENIZER, t)) for t in texts)
    assert all(sum(map(len, a)) <= 200_000 or len(a) == 1 for a in asked) and sum(map(len, asked)) == 33


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs).count() == 0


def test_token_files_round_trip(spark, odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(tokenfile, "FRAME_BYTES", 512)
    folder = staging_path(spark, "test-frames")
    manifest = tokenfile.write_ids(odd_docs, folder, files=4)
    assert 1 < manifest.count() <= 4
    out = tokenfile.read_ids(manifest, folder).orderBy("start").collect()
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert [r.doc_id for r in out] == [r[0] for r in order]
    for r in out:
        assert (r.start, 4 * r.n_tokens) == (start, len(r.ids))
        start += r.n_tokens
    want = sorted((d is None, d or 0, ids_of(tokenfile.TOKENIZER, t).tobytes()) for d, t, *_ in odd_rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids)) for r in out) == want
    some = tokenfile.read_ids(manifest, folder, {405, 401}).collect()
    assert sorted(r.doc_id for r in some) == [401, 405]
    again = {r.doc_id: (r.start, bytes(r.ids)) for r in out}
    assert all(again[r.doc_id] == (r.start, bytes(r.ids)) for r in some)


def test_token_file_detects_damage(tmp_path):
    import pyarrow.fs as pafs

    path = str(tmp_path / "one.zst")
    fs = pafs.LocalFileSystem()
    with fs.open_output_stream(path, compression=None) as sink:
        writer = tokenfile.FrameWriter(sink, 2)
        for k in range(3):
            writer.add(k, np.arange(1000 * k, dtype="<u2").tobytes())
            writer.flush()
        writer.close()
    with fs.open_input_file(path) as source:
        reader = tokenfile.FrameReader(source)
        assert [(k, s, len(x)) for k, s, x in reader.documents({2})] == [(2, 1000, 2000)]
        reader.table[1, 2] += 1
        with pytest.raises(ValueError, match="checksum"):
            list(reader.documents())


def test_token_files_of_nothing(spark, no_docs):
    folder = staging_path(spark, "test-frames")
    manifest = tokenfile.write_ids(no_docs, folder)
    assert tokenfile.digests(tokenfile.read_ids(manifest, folder)).count() == 0
