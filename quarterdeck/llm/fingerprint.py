"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A text's paragraphs are its lines, as they stand (empty lines count). Every paragraph is hashed
to a wide vector, and a document's fingerprint is the sum of its paragraphs' vectors modulo powers of two:

* ``SECURE`` lanes modulo 2**64, the paragraph's BLAKE2 digest: equal sums mean equal
  multisets of paragraphs (but for chance), whatever the order of the paragraphs;
* ``LIKE`` lanes modulo 2**32, a signed count sketch of the paragraph's three-word shingles.

Sums make the fingerprint incremental: ``combine`` adds the fingerprint of inserted paragraphs and
subtracts that of deleted ones, without the rest of the text. The likeness of two
fingerprints is ``2 a.b / (a.a + b.b)`` over the ``LIKE`` lanes, an estimate of the
likeness of the two multisets of shingles, cut to 0..1; equal fingerprints have likeness 1.

Scale: texts are fingerprinted where they are read. For the edited texts, the neighbour in
doc_id order is needed: documents cross one shuffle into doc_id ranges (bounds from a quantile sketch of
the ids), and each range gets a copy of the first document of the range below as its last row. Ranges
are streamed in order; no group is collected.

Defined cases: a null text is empty and has no paragraph; null doc_ids come last in descending order; rows with equal doc_ids
follow each other by text; the only row of a table is its own next document; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import batch_of, shuffle_partitions, text_slices, text_or_empty

SECURE, LIKE, SHINGLE = 4, 256, 3
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x2545F4914F6CDD1D


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, step: int) -> np.ndarray:
    out = np.full(n, np.uint64(step))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Fingerprinter:
    """Vectors of many texts at a time; ``lanes`` are ``SECURE`` words of 64 and ``LIKE`` words of 32 bits."""

    def __init__(self) -> None:
        self.powers, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _word_hashes(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every run of non-space bytes; ``breaks`` also ends words."""
        blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D)) | breaks
        edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        n = len(data) + 1
        if len(self.powers) < n:
            self.powers = _powers(2 * n, _BASE)
            self.inverse = _powers(2 * n, pow(_BASE, -1, 2**64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * self.powers[: n - 1], dtype=np.uint64)])
        return start, _scramble((sums[end] - sums[start]) * self.inverse[start])

    def sketches(self, texts: list[bytes]) -> np.ndarray:
        """The ``LIKE`` lanes of every text, shingles staying inside paragraphs; whole texts, one array pass."""
        n = len(texts)
        data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, n) + 1
        ends = np.cumsum(sizes)
        stop = np.zeros(len(data), bool)
        stop[ends - 1] = True
        start, words = self._word_hashes(data, stop)
        if not len(words):
            return np.zeros((n, LIKE), np.uint32)
        doc = np.searchsorted(ends, start, side="right")
        line = np.cumsum((data == 0x0A) | stop)[start]
        first = np.concatenate([[True], line[1:] != line[:-1]])
        place = np.arange(len(words)) - np.maximum.accumulate(np.where(first, np.arange(len(words)), 0))
        left = np.append(np.flatnonzero(first)[1:], len(words))[np.cumsum(first) - 1] - np.arange(len(words))
        shingle = words.copy()
        for k in range(1, SHINGLE):
            more = np.flatnonzero(left > k)
            shingle[more] = _scramble(shingle[more] * _MIX + words[more + k])
        kept = (left >= SHINGLE) | (place == 0)  # a shorter paragraph is one shingle
        shingle, doc = shingle[kept], doc[kept]
        lane = doc * LIKE + (shingle % np.uint64(LIKE)).astype(np.int64)
        sign = 1 - 2 * ((shingle >> np.uint64(40)) & np.uint64(1)).astype(np.int64)
        sums = np.bincount(lane[sign > 0], minlength=n * LIKE) - np.bincount(lane[sign < 0], minlength=n * LIKE)
        return sums.astype(np.int64).astype(np.uint32).reshape(n, LIKE)

    @staticmethod
    def secure(text: bytes) -> np.ndarray:
        if not text:
            return np.zeros(SECURE, np.uint64)
        digests = b"".join(hashlib.blake2b(p, digest_size=8 * SECURE).digest() for p in text.split(b"\n"))
        return np.frombuffer(digests, "<u8").reshape(-1, SECURE).sum(axis=0, dtype=np.uint64)

    def fingerprints(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """The packed fingerprints, and their ``LIKE`` lanes."""
        like = self.sketches(texts)
        return [pack(self.secure(t), v) for t, v in zip(texts, like, strict=True)], like


def pack(secure: np.ndarray, like: np.ndarray) -> bytes:
    return secure.astype("<u8").tobytes() + like.astype("<u4").tobytes()


def unpack(fingerprint: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(fingerprint, "<u8", SECURE), np.frombuffer(fingerprint, "<u4", LIKE, 8 * SECURE)


def combine(fingerprint: bytes, inserted: bytes | None = None, deleted: bytes | None = None) -> bytes:
    """The fingerprint after paragraphs with these fingerprints are inserted or deleted."""
    secure, like = unpack(fingerprint)
    for other, sign in ((inserted, 1), (deleted, -1)):
        if other is not None:
            s, v = unpack(other)
            secure, like = (secure + s, like + v) if sign > 0 else (secure - s, like - v)
    return pack(secure, like)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, of ``LIKE`` lanes; two rows without any shingle are alike."""
    x, y = a.view(np.int32).astype(np.float64), b.view(np.int32).astype(np.float64)
    both = (x * x).sum(axis=1) + (y * y).sum(axis=1)
    dot = 2 * (x * y).sum(axis=1)
    return np.clip(np.where(both > 0, dot / np.where(both > 0, both, 1), 1.0), 0.0, 1.0)


def encode(fingerprint: bytes) -> str:
    """Printable and short: the lanes' signs go to the last bit and their bytes stand by place, as most are small."""
    secure, like = unpack(fingerprint)
    signed = like.view("<i4")
    folded = ((signed << 1) ^ (signed >> 31)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return base64.b85encode(secure.tobytes() + zlib.compress(folded, 1)).decode()


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_texts(docs: DataFrame) -> DataFrame:
    """doc_id and the binary fingerprint of every document, where it is read."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.binary())])

    def run(batches):
        maker = Fingerprinter()
        for batch in text_slices(batches, 1):
            texts = [x.encode() for x in batch.column(1).to_pylist()]
            yield batch_of(schema, (batch.column(0), maker.fingerprints(texts)[0]))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, fingerprint binary"
    )


def _range_of(key: Column, bounds: list[int]) -> Column:
    """The range of a key, 0 for the largest and nulls in the last: a search in two levels of about the root of their number."""
    if not bounds:
        return F.lit(0)
    wide = math.isqrt(len(bounds) - 1) + 1
    parts = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda b: b < key))
    part = below(array([p[-1] for p in parts]))
    inside = F.get(F.array(*[array(p) for p in parts]), part)
    full = F.least(part * wide, F.lit(len(bounds)))
    return (F.lit(len(bounds)) - F.coalesce(full + F.when(inside.isNull(), 0).otherwise(below(inside)), F.lit(0))).cast("int")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id and text by ranges, descending, with a last row per range that only says what follows (``extra``)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ranges = shuffle_partitions(spark)
    cuts = [i / ranges for i in range(1, ranges)]
    found = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), cuts, 10 * ranges)).first()[0] if cuts else None
    bounds = sorted(set(found or []))
    place = _range_of(F.col("doc_id"), bounds)
    rows = rows.withColumn("bucket", place)
    # What stands first in each range: largest id, then the smallest text; a row per range.
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    tops = {r[0]: r[1] for r in ids.groupBy(place.alias("bucket")).agg(F.max("doc_id")).collect()}
    order = sorted(tops)
    after = {b: order[(i + 1) % len(order)] for i, b in enumerate(order)}
    goes = [(tops[nxt], b) for b, nxt in after.items()]
    if not goes:
        return rows.withColumn("extra", F.lit(False))
    heads = spark.createDataFrame(goes, "head long, goes int")  # a row per range
    extra = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head")))
    extra = extra.groupBy(F.col("goes").alias("bucket"), "doc_id").agg(F.min("text").alias("text"))
    both = rows.select("bucket", "doc_id", "text", F.lit(False).alias("extra")).unionByName(extra.withColumn("extra", F.lit(True)))
    dealt = both.repartitionById(len(bounds) + 1, F.col("bucket"))
    return dealt.sortWithinPartitions(F.col("extra"), F.col("doc_id").desc_nulls_last(), "text").select("doc_id", "text", "extra")


def _digest(batches):
    kinds = [("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]]
    schema = pa.schema([*kinds, ("near_edited", pa.float64()), ("near_next", pa.float64())])
    maker, held = Fingerprinter(), None

    def rows(items, following):
        texts = [t for _, t in items]
        changed = [edited(t, n) for t, n in zip(texts, [*texts[1:], following[1]], strict=True)]
        prints, like = maker.fingerprints([t.encode() for t in [*texts, following[1]]])
        raw = [t.encode() for t in changed]
        new, new_like = maker.fingerprints(raw)
        return batch_of(
            schema,
            (
                [k for k, _ in items],
                [len(t) for t in texts],
                [hashlib.sha256(t).hexdigest() for t in raw],
                [encode(p) for p in prints[:-1]],
                [encode(p) for p in new],
                near(prints[:-1], new, like[:-1], new_like),
                near(prints[:-1], prints[1:], like[:-1], like[1:]),
            ),
        )

    def near(a, b, x, y):
        return np.where([p == q for p, q in zip(a, b, strict=True)], 1.0, likeness(x, y))

    for batch in text_slices(batches, 1):
        keys, texts, extra = (c.to_pylist() for c in batch.columns)
        items = list(zip(keys, texts, strict=True))
        real = items[: len(items) - sum(extra)]
        every = ([held] if held else []) + real + (items[len(real) :][:1])
        if len(every) > 1:
            yield rows(every[:-1], every[-1])
        held = None if any(extra) else every[-1]


def op2_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return docs.mapInArrow(_digest, schema)
