"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles, banded and verified.

1. Texts become multisets of five-word shingles. Document frequencies are counted over all documents in ``CELLS`` hashed
   counters (their error is a fixed share of the corpus, about words-per-text / CELLS, at every size). A shingle
   weighs ``tf * ln(1 + N / (df + N))``: the prior of N in the document frequency keeps shingles that near copies share
   from weighing much less than those in which they differ.
2. Texts with the same words are copies; the smallest doc_id of them stands for all in the search.
3. Improved consistent weighted sampling (Ioffe) draws ``BANDS * ROWS`` samples per text; two texts agree in a
   sample with the probability of their weighted Jaccard likeness. ``ROWS`` samples make a band's key; a byte
   of every sample makes the signature.
4. Texts that share a key and agree in ``AGREE`` samples or more are candidates. They are joined in turns: in every bucket with several
   components the largest has a pivot (at first the text that shares most keys with others: what copies are made from, if it is there; later any of its
   texts), and every text of another component is compared, exactly, with one pivot: the one that it shares most buckets with (weighted Jaccard
   >= 0.8 is a link). So a turn compares each text once at most, whatever its group's size. Turns go on while ``WORTH`` of the comparisons are links.
   What then is still in buckets of several components meets by keys of ``PART_ROWS`` of ``FINE`` samples drawn anew; each pair of different components
   that agrees in ``FINE_AGREE`` of them is compared, but for those that a pivot rules out: 1 - likeness is a metric, so texts whose distances to
   a pivot differ by over 0.2 are not linked.
5. A class is a connected component of links and copies; its id is its smallest doc_id.

Scale: two passes over the texts without a shuffle (counts; samples); keys are 8 bytes per band. Only texts in buckets
are fetched for comparison. Buckets are never gathered in a task: pivots are map-side combined minima, comparisons a join.
No bucket is capped, and all buckets are treated alike.

Defined cases: a null text is empty; texts without words are classed by equality of the text; rows with equal doc_ids are one document
(its texts' links are joint); rows with a null doc_id have a null class; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterdeck.llm.bits import bitmap, with_bits
from quarterdeck.llm.common import batch_of, free_prefix, staged, text_or_empty, text_slices
from quarterdeck.llm.components import components
from quarterdeck.llm.counters import CELLS, added, cells, sliced
from quarterdeck.llm.shingles import MIX, Shingler, scramble

SHINGLE, SIMILAR = 5, 0.8
#: P(no shared band at likeness 0.8) = (1 - 0.8 ** ROWS) ** BANDS < 0.0003; P(fewer than AGREE of 64 samples agree) < 0.0001.
BANDS, ROWS, AGREE, WORTH = 16, 4, 38, 0.1
#: P(fewer than FINE_AGREE of FINE samples agree at likeness 0.8) < 0.0003; P(no shared key of PART_ROWS of them) < 0.000003.
FINE, FINE_AGREE, PART_ROWS = 256, 182, 6
TEXT_BYTES = 250_000


class WeightedSampler:
    """Consistent weighted samples; a shingle's random variables come from three parts of its hash by table."""

    def __init__(self, samples: int, seed: int = 23, bits: int = 14):
        rng = np.random.default_rng(seed)
        shape, self.bits = (samples, 1 << bits), bits
        self.r = rng.standard_gamma(2.0, shape, np.float32)
        self.log_c = np.log(rng.standard_gamma(2.0, shape, np.float32))
        self.beta = rng.random(shape, np.float32)
        self.salt = scramble(np.arange(1, samples + 1, dtype=np.uint64) * MIX)

    def sample(self, bounds: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """A 64-bit value per sample and text; ``bounds`` are the texts' places among the shingles, none empty."""
        last = np.uint64((1 << self.bits) - 1)
        at = [((shingle >> np.uint64(s)) & last).astype(np.int64) for s in (0, 16, 32)]
        log_w = np.log(weight).astype(np.float32)
        out = np.empty((len(self.r), len(bounds) - 1), np.uint64)
        starts = bounds[:-1]
        of = np.repeat(np.arange(len(starts)), np.diff(bounds))
        for k in range(len(self.r)):
            r, beta = self.r[k][at[0]], self.beta[k][at[2]]
            t = np.floor(log_w / r + beta)
            value = self.log_c[k][at[1]] - r * (t - beta + 1)
            least = np.minimum.reduceat(value, starts)
            hit = np.flatnonzero(value == least[of])
            first = hit[np.searchsorted(hit, starts)]  # shingles are in order of hash, so ties go to the smallest
            out[k] = scramble(shingle[first] ^ (t[first].astype(np.int64).astype(np.uint64) * MIX) ^ self.salt[k])
        return out


def keyed_counts(docs: DataFrame) -> DataFrame:
    """doc_id and key of every text, and per task the slices of its document-frequency counters (slice, counts)."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("slice", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        shingler, counts = Shingler(SHINGLE), np.zeros(CELLS, np.int64)
        for batch in text_slices(batches, 1, TEXT_BYTES):
            place, shingle, _, keys = shingler.counted(batch.column(1).to_pylist())
            counts += np.bincount(cells(shingle), minlength=CELLS)
            nothing = [None] * len(keys)
            yield batch_of(schema, (batch.column(0), keys, nothing, nothing))
        if counts.any():
            slices, parts = zip(*sliced(counts), strict=True)
            yield batch_of(schema, ([None] * len(parts), [None] * len(parts), slices, parts))

    return docs.mapInArrow(run, "doc_id long, key binary, slice int, counts binary")


def idf_table(counts: DataFrame, documents: int) -> np.ndarray:
    """The weight of every cell."""
    n = max(documents, 1)
    return np.log1p(n / (np.minimum(added(counts), n) + n)).astype(np.float32)


def keys_of(drawn: np.ndarray, rows: int) -> list[list[int]]:
    """Per text, a key of every ``rows`` samples (of the last, if fewer are left, none)."""
    bands = len(drawn) // rows
    keys = drawn[: bands * rows].reshape(bands, rows, -1)
    band = scramble(keys[:, 0] + np.arange(bands, dtype=np.uint64)[:, None] * MIX)
    for r in range(1, rows):
        band = scramble(band * MIX + keys[:, r])
    return band.T.astype(np.int64).tolist()


def band_keys(docs: DataFrame, idf) -> DataFrame:
    """doc_id, band keys and signature (a byte per sample, eight to a number) of every text with words."""
    schema = pa.schema([("doc_id", pa.int64()), ("bands", pa.list_(pa.int64())), ("signature", pa.list_(pa.int64()))])

    def run(batches):
        shingler, sampler = Shingler(SHINGLE), WeightedSampler(BANDS * ROWS)
        for batch in text_slices(batches, 1, TEXT_BYTES):
            place, shingle, n, _ = shingler.counted(batch.column(1).to_pylist())
            if not len(place):
                continue
            texts, starts = np.unique(place, return_index=True)
            drawn = sampler.sample(np.append(starts, len(place)), shingle, n * idf.value[cells(shingle)])
            signature = np.ascontiguousarray(drawn.astype(np.uint8).T).view("<i8")
            yield batch_of(schema, (batch.column(0).take(pa.array(texts)), keys_of(drawn, ROWS), signature.tolist()))

    return docs.mapInArrow(run, "doc_id long, bands array<long>, signature array<long>")


def fine_signatures(texts: DataFrame, idf) -> DataFrame:
    """doc_id, a signature of ``FINE`` further samples, and the keys of every ``PART_ROWS`` of them."""
    schema = pa.schema([("doc_id", pa.int64()), ("fine", pa.list_(pa.int64())), ("parts", pa.list_(pa.int64()))])

    def run(batches):
        shingler, sampler = Shingler(SHINGLE), WeightedSampler(FINE, seed=29)
        for batch in text_slices(batches, 1, TEXT_BYTES):
            place, shingle, n, _ = shingler.counted(batch.column(1).to_pylist())
            if len(place):
                found, starts = np.unique(place, return_index=True)
                drawn = sampler.sample(np.append(starts, len(place)), shingle, n * idf.value[cells(shingle)])
                signature = np.ascontiguousarray(drawn.astype(np.uint8).T).view("<i8")
                yield batch_of(schema, (batch.column(0).take(pa.array(found)), signature.tolist(), keys_of(drawn, PART_ROWS)))

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, fine array<long>, parts array<long>")


def agreeing(one: str, two: str, samples: int = BANDS * ROWS) -> Column:
    """In how many samples two signatures agree: bytes that are zero in the difference, eight at a time."""

    def spread(by: int):  # in the end the last bit of every byte is whether any of its bits was set
        return lambda v: v.bitwiseOR(F.shiftrightunsigned(v, by))

    differs = F.zip_with(one, two, lambda a, b: a.bitwiseXOR(b))
    for by in (4, 2, 1):
        differs = F.transform(differs, spread(by))
    bits = F.aggregate(differs, F.lit(0), lambda n, v: n + F.bit_count(v.bitwiseAND(F.lit(0x0101010101010101))))
    return F.lit(samples) - bits


def compared(pairs: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """a, b and the weighted Jaccard likeness of pairs of documents (the largest, if an id has several texts)."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("likeness", pa.float64())])

    def run(batches):
        shingler, held, own = Shingler(SHINGLE), None, None

        def weights(text: str):
            _, shingle, n, _ = shingler.counted([text])
            return shingle, n * idf.value[cells(shingle)].astype(np.float64)

        for batch in text_slices(batches, 3):
            out = []
            for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if one != held:
                    held, own = one, weights(one)
                other = weights(two)
                _, i, j = np.intersect1d(own[0], other[0], assume_unique=True, return_indices=True)
                both = np.minimum(own[1][i], other[1][j]).sum()
                union = own[1].sum() + other[1].sum() - both
                out.append(float(both / union) if union else 0.0)
            yield batch_of(schema, (batch.column(0), batch.column(1), out))

    got = rows.mapInArrow(run, "a long, b long, likeness double")
    return got.groupBy("a", "b").agg(F.max("likeness").alias("likeness"))


def near_links(docs: DataFrame, buckets: DataFrame, bands: DataFrame, idf) -> DataFrame:
    """a, b of linked documents that share a bucket; ``buckets`` has band, key, doc_id. Enough links for all components."""
    here = buckets.select("doc_id").distinct()
    # A bitmap instead of a join: the texts stay where they are read, and a few more than needed do no harm.
    held = docs.sparkSession.sparkContext.broadcast(bitmap(here.select(F.xxhash64("doc_id").alias("mark")), "mark"))
    texts = staged(with_bits(docs.withColumn("mark", F.xxhash64("doc_id")), held, True).drop("mark"), "near-texts")
    signature = staged(bands.select("doc_id", "signature").join(here, "doc_id", "left_semi"), "near-signatures")
    one = signature.select(F.col("doc_id").alias("a"), F.col("signature").alias("one"))
    two = signature.select(F.col("doc_id").alias("b"), F.col("signature").alias("two"))
    degree = buckets.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    placed = staged(buckets.drop("n").join(degree, "doc_id").withColumn("component", F.col("doc_id")), "near-degrees")
    placed, links, tested, turn = _mixed(placed, ["band", "key"]), None, None, 0
    while True:
        placed = staged(placed, f"near-placed-{turn}")
        pairs = _one_pivot_each(placed, turn).join(two, "b").join(one, "a").where(agreeing("one", "two") >= AGREE).select("a", "b")
        done = staged(compared(pairs, texts, idf), f"near-compared-{turn}")
        found = done.where(F.col("likeness") >= SIMILAR).select("a", "b")
        links = found if links is None else links.unionByName(found)
        tested = tested or done
        tally = done.agg(F.count(F.lit(1)), F.count_if(F.col("likeness") >= SIMILAR)).first()
        if tally[1]:
            own = components(links).withColumnRenamed("node", "doc_id")
            placed = placed.select("band", "key", "doc_id", "degree").join(own, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
            placed = _mixed(placed, ["band", "key"])
        if tally[1] <= WORTH * tally[0]:
            break
        turn += 1
    left = staged(placed.select("doc_id", "component").distinct(), "near-left")
    if left.isEmpty():
        return links
    # Distance to the first turn's pivot; a pivot's own is 0.
    far = tested.select(F.col("b").alias("doc_id"), F.col("a").alias("pivot"), (1 - F.col("likeness")).alias("far"))
    far = far.unionByName(tested.select(F.col("a").alias("doc_id"), F.col("a").alias("pivot"), F.lit(0.0).alias("far")).distinct())
    far = far.groupBy("doc_id").agg(F.min(F.struct("far", "pivot")).alias("known"))
    fine = staged(fine_signatures(texts.join(left.select("doc_id"), "doc_id", "left_semi"), idf), "near-fine")
    parts = left.join(fine.select("doc_id", F.posexplode("parts").alias("part", "part_key")), "doc_id")
    parts = _mixed(staged(parts, "near-parts"), ["part", "part_key"]).join(far, "doc_id", "left")
    parts = staged(parts.join(fine, "doc_id"), "near-some")
    # Pairs of different components: all but a bucket's largest component meet everything else in the bucket.
    some = parts.where(F.col("component") != F.col("main")).select(
        "part", "part_key", F.col("doc_id").alias("x"), F.col("known").alias("known_x"), F.col("component").alias("cx"), F.col("fine").alias("fine_one"), F.col("parts").alias("parts_x"),
    )
    every = parts.select(
        F.col("part").alias("part_y"), F.col("part_key").alias("key_y"), F.col("doc_id").alias("y"), F.col("known").alias("known_y"),
        F.col("component").alias("cy"), F.col("fine").alias("fine_two"), F.col("main").alias("main_y"), F.col("parts").alias("parts_y"),
    )
    apart = (F.col("known_x.pivot") == F.col("known_y.pivot")) & (F.abs(F.col("known_x.far") - F.col("known_y.far")) > 1 - SIMILAR + 1e-9)
    once = (F.col("cy") == F.col("main_y")) | (F.col("x") < F.col("y"))
    # A pair is looked at in the first part that it shares, and only there.
    first = F.array_position(F.zip_with("parts_x", "parts_y", lambda a, b: a == b), F.lit(True)) == F.col("part") + 1
    alike = agreeing("fine_one", "fine_two", FINE) >= FINE_AGREE
    same = (F.col("part") == F.col("part_y")) & (F.col("part_key") == F.col("key_y"))
    rest = some.join(every, same & (F.col("cx") != F.col("cy")) & once & ~F.coalesce(apart, F.lit(False)) & first & alike)
    rest = staged(rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "near-rest")
    late = compared(rest, texts, idf).where(F.col("likeness") >= SIMILAR).select("a", "b")
    return links.unionByName(staged(late, "near-late"))


def _mixed(placed: DataFrame, by: list[str]) -> DataFrame:
    """The rows of buckets with several components; adds the largest of them (of equals the one with the highest degree)."""
    most = F.max("degree") if "degree" in placed.columns else F.lit(0)
    sizes = placed.groupBy(*by, "component").agg(F.count(F.lit(1)).alias("size"), most.alias("most"))
    largest = F.max(F.struct("size", "most", (-F.col("component")).alias("minus"))).alias("largest")
    main = sizes.groupBy(by).agg(largest, F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return placed.join(main.select(*by, (-F.col("largest.minus")).alias("main")), by)


def _one_pivot_each(placed: DataFrame, turn: int) -> DataFrame:
    """a, b: a pivot for every text that is not of its bucket's largest component, of its buckets' pivots the one it meets most often."""
    by = ["band", "key"]
    order = F.col("degree") if turn == 0 else F.xxhash64("doc_id", F.lit(turn))
    best = F.max(F.struct(order.alias("order"), (-F.col("doc_id")).alias("minus"))).alias("best")
    pivot = placed.where(F.col("component") == F.col("main")).groupBy(by).agg(best).select(*by, (-F.col("best.minus")).alias("a"))
    met = placed.where(F.col("component") != F.col("main")).join(pivot, by).groupBy(F.col("doc_id").alias("b"), "a").agg(F.count(F.lit(1)).alias("times"))
    most = met.groupBy("b").agg(F.max(F.struct("times", (-F.col("a")).alias("minus"))).alias("most"))
    return most.select((-F.col("most.minus")).alias("a"), "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and class_id of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    seen = staged(keyed_counts(docs), "near-keys")
    keys = seen.where(F.col("key").isNotNull()).select("doc_id", "key")
    idf = spark.sparkContext.broadcast(idf_table(seen.where(F.col("slice").isNotNull()), keys.count()))
    keys = keys.where(F.col("doc_id").isNotNull()).withColumnRenamed("key", "words")
    copies = keys.groupBy("words").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copy_links = copies.where("n > 1").join(keys, "words").where(F.col("doc_id") != F.col("first"))
    copy_links = staged(copy_links.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct(), "near-copies")
    known = docs.where(F.col("doc_id").isNotNull())
    bands = staged(band_keys(known, idf), "near-all-bands")
    stand = copies.select(F.col("first").alias("doc_id")).distinct()
    bands = staged(bands.join(stand, "doc_id", "left_semi"), "near-bands")
    rows = bands.select("doc_id", F.posexplode("bands").alias("band", "key"))
    full = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = staged(rows.join(full, ["band", "key"]), "near-buckets")
    links = copy_links if buckets.isEmpty() else near_links(known, buckets, bands, idf).unionByName(copy_links)
    own = components(links)
    ids = seen.where(F.col("key").isNotNull()).select("doc_id")
    out = ids.join(own.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", F.coalesce("component", "doc_id").alias("class_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose doc_id is its class; of several rows with that doc_id, the first by
    text hash, text and then the other columns. Rows with a null doc_id stay."""
    p = free_prefix(docs.columns)
    classes = near_duplicates(docs).where(F.col("doc_id") == F.col("class_id"))
    kept = classes.groupBy(F.col("doc_id").alias(f"{p}id")).agg(F.count(F.lit(1)).alias(f"{p}n"))
    rows = docs.join(kept, F.col("doc_id").cast("long") == F.col(f"{p}id"))
    names = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    order = Window.partitionBy(f"{p}id").orderBy(F.xxhash64("text"), *names)
    single = F.when(F.col(f"{p}n") == 1, F.lit(1)).otherwise(F.row_number().over(order))
    rows = rows.withColumn(f"{p}place", single).where(F.col(f"{p}place") == 1).select(*docs.columns)
    return rows.unionByName(docs.where(F.col("doc_id").isNull()))


def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
