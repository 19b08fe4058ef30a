import random

import pytest
from llm_samples import words
from quarterdeck.llm.common import importable

CLASHING = ("key", "piece", "label", "size", "bucket", "n", "u", "score", "mark", "first", "bands", "_copies", "best", "extra")


@pytest.fixture(autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with every odd case: (doc_id, text, lang, source)."""
    rng = random.Random(3)
    base = words(rng, 300)
    passage = words(rng, 60)
    rows = [(i, words(rng, rng.randrange(1, 120)), "en", f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, base, "en", "s0") for i in range(5)]  # copies
    rows += [(200 + i, base + f" tail{i}", "fr", "s1") for i in range(6)]  # near copies
    rows += [(300 + i, words(rng, 40) + " " + passage + " " + words(rng, 40), "en", None) for i in range(4)]
    rows += [(400, None, None, None), (401, "", "en", "s2"), (402, "", "en", "s2"), (403, " \n\t ", "en", "s3"), (404, "%% $$", "en", "s3")]
    rows += [(405, words(rng, 9000), "en", "s0"), (406, "ab " * 5000, "en", "s0"), (407, "x" * 3000, "en", "s1")]
    rows += [(408, "Éa 中文 ½ 's <|endoftext|> ok b", "xx", "s2"), (409, "one two", "en", "s2"), (410, "one two", "en", "s2")]
    rows += [(411, "same row here", "en", "s2")] * 3  # repeated rows
    rows += [(412, "first text of an id", "en", "s2"), (412, "second text of that id", "en", "s2")]
    rows += [(None, base, "en", "s0"), (None, None, "en", "s0"), (-5, "minus", "en", "")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows over several partitions, with columns whose names operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    rows = [(*r, None if r[1] is None else len(r[1]), *(None if i % 2 else "z" for i in range(len(CLASHING)))) for r in odd_rows]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)
