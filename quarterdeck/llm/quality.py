"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

A text is compressed with a dictionary trained on good texts, with one trained on bad texts, and with none. Its
evidence is the normalised difference ``(bad size - good size) / larger size``; the sizes per byte and
the length go beside it, as how much a difference tells depends on them. A logistic regression on
the labelled documents turns that into a calibrated score.

Bounds (parameters): ``SHARE`` of five labelled documents may teach the dictionaries, and the regression learns from the others, which the
dictionaries have not seen. Dictionaries come from at most ``DICT_ROWS`` documents and ``DICT_BYTES`` bytes of whole texts per class, the
regression from at most ``FIT_ROWS`` documents, both in order of a hash of the id. Sizes alone decide what fits: a text too large
for what is left of the bytes is passed over, and the next ones still have their chance. Everything else covers all documents; the pass over the texts needs no shuffle, and only its
numbers are joined with labels.

Defined cases: of equal ids the texts count each, in order of their hash; a null text is empty, an empty text is scored by its sizes as any other; repeated rows are scored each; if
there are no labels of a class to learn from, every score is the mean label (0.5 without any); an empty table gives no rows.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import batch_of, fit_logistic, held_out, labelled_ids, logistic, staged, text_or_empty, text_slices

DICT_ROWS, DICT_BYTES, DICT_SIZE = 3000, 6_000_000, 112_640
FIT_ROWS, SHARE = 50_000, 3
LEVEL = 3
THRESHOLD = 0.3
SIZES = ("difference", "good", "bad", "plain", "length")


def dictionary(samples: list[bytes], size: int = DICT_SIZE) -> bytes:
    """A trained dictionary; of few samples, their bytes themselves."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(total // 10, 1024)), samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b" " * 8


def teaches() -> Column:
    """Labelled documents that the dictionaries may be made of; the others are for the regression."""
    return F.pmod(F.xxhash64("doc_id", F.lit("teach")), F.lit(5)) < SHARE


def fitting(sizes: list[int], limit: int) -> list[int]:
    """Places of the sizes taken, in order, as long as each fits into what is left of ``limit``."""
    taken, left = [], limit
    for i, size in enumerate(sizes):
        if 0 < size <= left:
            taken.append(i)
            left -= size
    return taken


def class_samples(docs: DataFrame, ids: DataFrame, rows: int = DICT_ROWS, limit: int = DICT_BYTES) -> dict[int, list[bytes]]:
    """Whole texts by class: of at most ``rows`` documents those that fit into ``limit`` bytes. Two scans: sizes, then the chosen texts."""
    chosen = None
    for label in (1, 0):
        some = ids.where((F.col("label") == label) & teaches()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = some if chosen is None else chosen.unionAll(some)
    mark = F.xxhash64("text")
    found = docs.join(F.broadcast(chosen), "doc_id").select("label", "doc_id", mark.alias("mark"), F.octet_length("text").alias("size"))
    found = found.dropDuplicates().orderBy("label", F.xxhash64("doc_id"), "doc_id", "mark").collect()  # numbers of at most 2 * rows documents
    kept = []
    for label in (0, 1):
        own = [r for r in found if r["label"] == label]
        kept += [(own[i]["doc_id"], own[i]["mark"], label) for i in fitting([r["size"] for r in own], limit)]
    out: dict[int, list[bytes]] = {0: [], 1: []}
    if kept:
        wanted = docs.sparkSession.createDataFrame(kept, "doc_id long, mark long, label int")
        texts = docs.withColumn("mark", mark).join(F.broadcast(wanted), ["doc_id", "mark"]).select("label", "doc_id", "mark", "text").dropDuplicates()
        for r in texts.orderBy(F.xxhash64("doc_id"), "doc_id", "mark", "text").collect():  # at most 2 * limit bytes
            out[r["label"]].append(r["text"].encode())
    return out


def compressed_sizes(docs: DataFrame, good: bytes, bad: bytes, level: int = LEVEL) -> DataFrame:
    """doc_id and the columns ``SIZES`` of every document."""
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.float64()) for c in SIZES]])

    def run(batches):
        kinds = []
        for data in (good, bad):
            held = zstandard.ZstdCompressionDict(data)
            held.precompute_compress(level=level)
            kinds.append(zstandard.ZstdCompressor(level=level, dict_data=held).compress)
        kinds.append(zstandard.ZstdCompressor(level=level).compress)
        for batch in text_slices(batches, 1):
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            size = np.array([len(t) for t in texts], np.float64)
            g, b, p = (np.array([len(f(t)) for t in texts], np.float64) for f in kinds)
            each = size + 20
            yield batch_of(schema, (batch.column(0), (b - g) / np.maximum(b, g), g / each, b / each, p / each, np.log1p(size)))

    return docs.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} double" for c in SIZES))


def _terms() -> list:
    d, g, b, p, n = (F.col(c) for c in SIZES)
    return [d, g, b, p, n, d * d, g * g, b * b, p * p, n * n, d * n, g * n, b * n, p * n]


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and the sizes behind it, of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ids = labelled_ids(labels, "quality", FIT_ROWS)
    ids = staged(ids, "quality-ids")
    samples = class_samples(docs, ids)
    sizes = staged(compressed_sizes(docs, dictionary(samples[1]), dictionary(samples[0])), "quality-sizes")
    terms = _terms()
    known = F.broadcast(ids.where(~teaches()))  # two numbers for each of at most FIT_ROWS documents
    fit = sizes.join(known, "doc_id").select("label", *[t.alias(f"t{i}") for i, t in enumerate(terms)])
    fit = np.array(fit.orderBy(*fit.columns).limit(2 * FIT_ROWS).collect(), np.float64).reshape(-1, len(terms) + 1)
    if len(np.unique(fit[:, 0])) == 2:
        score = logistic(terms, fit_logistic(fit[:, 1:], fit[:, 0]))
    else:
        score = F.lit(float(fit[:, 0].mean()) if len(fit) else 0.5)
    score = F.when(F.isnan(score), F.lit(0.5)).otherwise(score)
    return sizes.select("doc_id", held_out().alias("held_out"), score.alias("score"), *SIZES)


def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_scores(docs, labels)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
