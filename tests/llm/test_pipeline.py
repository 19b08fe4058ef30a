"""The pipeline's stages: columns, decisions taking effect, odd rows, and the guard in the entry module."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import pytest
from llm_samples import words
from quarterdeck.llm.common import staged
from quarterdeck.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES
from quarterdeck.llm.suffix import kept_bytes
from quarterdeck.llm.tokens import default_path
from test_mixing import brute as brute_mix
from test_texts import brute_classes, brute_spans


def test_stages_on_odd_rows(spark, odd_docs, no_docs, tmp_path):
    labels = [(i, 1, int(i % 9 == 0)) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_docs, no_docs):
        rows = staged(docs, "test-stage")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = rows
            rows = staged(stage(spark, rows, str(tmp_path)), "test-stage")
            assert rows.columns == docs.columns, name
            assert {f.name: f.dataType for f in rows.schema} == {f.name: f.dataType for f in docs.schema}, name
            assert {r.doc_id for r in rows.collect()} <= {r.doc_id for r in before.collect()}, name
        last = corpus_pipeline.STAGES[-1][1](spark, rows, str(tmp_path))
        pieces = Counter(r.doc_id for r in last.collect())
        assert set(pieces) == {r.doc_id for r in rows.select("doc_id").collect()}


def planted():
    """Documents (doc_id, text, lang, source) and the ids of the toxic ones; copies, near copies and a passage that four documents share."""
    rng = random.Random(12)
    rows = [(i, words(rng, rng.randrange(40, 90), 300), "en", f"s{i % 3}") for i in range(320)]
    toxic = {i for i in range(0, 320, 4)}
    rows = [(i, t + " vile filth scum " + words(rng, 40, 300) if i in toxic else t, *rest) for i, t, *rest in rows]
    base = [f"b{i}" for i in range(150)]
    rows += [(1000 + i, " ".join(base), "en", "s1") for i in range(12)]  # exact copies
    for i in range(12):  # near copies: two words changed
        text = list(base)
        for p in rng.sample(range(150), 2):
            text[p] = f"n{rng.randrange(10**6)}"
        rows.append((2000 + i, " ".join(text), "fr", "s2"))
    passage = words(rng, 60)
    rows += [(3000 + i, words(rng, 50) + " " + passage + " é " + words(rng, 30), "en", None if i else "s0") for i in range(4)]
    rows += [(4000, "", "en", "s0"), (4001, "long " + words(rng, 6000), "en", "s2")]
    rng.shuffle(rows)
    return rows, toxic


def test_run_equals_a_plain_version(spark, tmp_path):
    """All rows of run(), stage by stage in plain Python: planted labels, pairwise likeness, every 200-byte string, the mix, the tokenizer."""
    from tokenizers import Tokenizer

    rows, toxic = planted()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], schema).repartition(4)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 1, int(r[0] in toxic)) for r in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = [r for r in rows if r[0] not in toxic]
    classes = brute_classes(left)
    left = [r for r in left if classes[r[0]] == r[0]]
    assert len(left) < len(rows) - len(toxic) - 20  # the copies went
    spans = brute_spans([r[1].encode() for r in left], 200)
    assert sum(map(bool, spans)) == 4
    left = [(d, kept_bytes(t.encode(), [{"begin": b, "end": e} for b, e in own]).decode(errors="ignore"), *rest) for (d, t, *rest), own in zip(left, spans, strict=True)]
    taken, _ = brute_mix(left)
    copies = {d: n // size for d, size, n in taken if size}
    tokenizer, want = Tokenizer.from_file(default_path("word_bpe_49k.json")), Counter()
    for d, text, *_ in left:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        start = 0
        while start < len(ids):
            rest = len(ids) - start
            length = 4096 if rest >= 4096 else 1 << (rest.bit_length() - 1)
            piece = b"".join(i.to_bytes(4, "little") for i in ids[start : start + length])
            want[(d, start, length, zlib.crc32(piece), len(ids))] += copies.get(d, 0)
            start += length
    pieces = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got)
    empty = (4000, 0, 1, zlib.crc32((2).to_bytes(4, "little")), 1)
    assert 1 <= pieces.pop(empty) <= 2  # words taken do not tell how often an empty text is
    assert pieces == +want
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and {r.offset for r in got} == {0}


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = {*LLM_QUERIES, "pipeline"}
    assert names <= set(entry.queries()) and set(LLM_ORACLE_SQL) <= names
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffixes", "mixing", "packing"]


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_oracle(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.sql(LLM_ORACLE_SQL[name]).df()
    got = LLM_QUERIES[name](spark, sf).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    one, two = (f[columns].sort_values(columns).reset_index(drop=True) for f in (got, want))
    assert one.equals(two.astype(one.dtypes.to_dict()))


def test_batches_for_workers_are_small_whatever_the_texts(spark):
    import os

    import pyarrow as pa
    from quarterdeck.llm.common import BATCH_BYTES, GIVEN_BACK

    def sizes(batches):
        limits = all(os.environ.get(k) == v for k, v in GIVEN_BACK.items())
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [b.nbytes], "limits": [limits]})

    docs = spark.range(0, 6000, 1, 1).selectExpr("id", "repeat('x', 3000) text")
    got = docs.mapInArrow(sizes, "n long, bytes long, limits boolean").collect()
    assert sum(r.n for r in got) == 6000 and all(r.limits for r in got)
    assert max(r.bytes for r in got) < 1.1 * BATCH_BYTES
