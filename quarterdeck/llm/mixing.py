"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Every source gets a target number of words (``source_targets``). Its documents then get
``target / source words`` expected copies each: the whole part is taken for certain, and
the fraction is the inclusion probability ``pi`` of one more copy. Documents are ranked by

    (u / (1 - u)) / (pi / (1 - pi)),    u uniform from a hash of the document's id,

and taken in that order up to the source's remaining words, the document at the edge
going to the nearer side. Inclusion probabilities differ between sources, and sizes differ
between documents; the sample's size in words is fixed.

Scale: one pass computes the sizes; documents are then only counted into ``(source, bucket
of u)`` sums (map-side combined). Running sums over buckets find the one bucket per source
that holds the edge, and only that bucket's rows (about ``BUCKET_ROWS``) are ranked in a
window. A source with a third of all rows therefore has no task of its own, apart
from its bucket sums.

Defined cases: a null text has size 0; null is a source of its own, last; repeated rows are
documents of their own (equal ids tie; ties go by size and then are alike); sizes of
zero are never repeated beyond ``cap`` and take 0 words; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from quarterdeck.llm.common import checkpointed, free_prefix, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
#: Rows that one bucket of the ranking holds on average.
BUCKET_ROWS = 4096
#: Of 52 bits of hash; u is in (0, 1).
U_SCALE = float(2**52)


def uniform(key: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(U_SCALE)


def sized(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text_or_empty()).alias("mark"),
        uniform(F.col("doc_id"), seed).alias("u"),
    )


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """A row per source: its words, rows and target.

    The targets share ``budget`` times all words by weight; a target above ``cap`` times its
    source's words stops there and the excess goes to the others by weight. The level at which
    that settles follows from one running sum over the sources in order of cap / weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    by_name = W.Window.orderBy(F.col("source").asc_nulls_last())  # a row per source
    slot = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), slot + 1))
    per = per.withColumn("most", F.lit(cap) * F.col("source_size"))
    by_cap = W.Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = by_cap.rowsBetween(W.Window.unboundedPreceding, -1), W.Window.partitionBy()
    level = (F.lit(budget) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    per = per.withColumn("level", level).withColumn("open", F.col("most") > F.col("level") * F.col("weight"))
    settled = F.max(F.when(F.col("open"), F.col("level"))).over(every)
    target = F.when(F.col("open"), F.least(settled * F.col("weight"), F.col("most"))).otherwise(F.col("most"))
    return per.select("source", "source_size", "source_rows", target.cast("double").alias("target"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = 1.5, cap: float = 2.0, seed: int = 7) -> DataFrame:
    """Copies of every document: doc_id, source, mark (hash of the text), size, source_size, target, copies, taken."""
    sizes = checkpointed(sized(docs, seed))
    targets = source_targets(sizes, weights, budget, cap)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = (
        targets.withColumn("whole", F.floor(share))
        .withColumn("pi", share - F.col("whole"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("buckets", F.greatest(F.ceil(F.col("source_rows") / BUCKET_ROWS), F.lit(1)))
    )
    targets = checkpointed(targets)
    key = F.col("key")
    # Pareto rank: random odds over inclusion odds (null where nothing more is wanted).
    ranked = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    ranked = ranked.withColumn("key", (F.col("u") / (1.0 - F.col("u"))) / F.nullif(F.col("pi") / (1.0 - F.col("pi")), F.lit(0.0)))
    ranked = ranked.withColumn("bucket", F.floor(F.col("u") * F.col("buckets")))  # the key rises with u in a source
    sums = sizes.join(targets.select("source", "buckets", "rest"), sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    sums = sums.groupBy("source", F.floor(F.col("u") * F.col("buckets")).alias("bucket")).agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest")
    )
    upto = F.sum("words").over(W.Window.partitionBy("source").orderBy("bucket"))
    edge = (
        sums.withColumn("start", upto - F.col("words"))
        .where(F.col("start") <= F.col("rest"))
        .groupBy("source")
        .agg(F.max("bucket").alias("edge"), F.max("start").alias("start"))
    )
    edge = edge.withColumnRenamed("source", "edge_source")
    placed = ranked.join(edge, F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source")
    in_edge = F.col("bucket") == F.col("edge")
    within = W.Window.partitionBy("source").orderBy(key, "doc_id", "size").rowsBetween(W.Window.unboundedPreceding, 0)
    near = placed.where(in_edge).withColumn("before", F.col("start") + F.sum("size").over(within) - F.col("size"))
    near = near.withColumn("extra", (F.col("pi") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("rest")))
    far = placed.where(~F.coalesce(in_edge, F.lit(False)))
    far = far.withColumn("extra", (F.col("pi") > 0) & (F.col("bucket") < F.col("edge")))
    both = near.drop("before").unionByName(far)
    copies = (F.col("whole") + F.coalesce(F.col("extra"), F.lit(False)).cast("long")).cast("long")
    return both.select(
        "doc_id",
        "source",
        "mark",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it.

    Rows alike in doc_id, source and text are interchangeable: one of them stands for the copies of all.
    """
    p = free_prefix(docs.columns)
    key, copies = [f"{p}id", f"{p}source", f"{p}mark"], f"{p}copies"
    taken = mix(docs, **options).groupBy(*[F.col(c).alias(k) for c, k in zip(("doc_id", "source", "mark"), key, strict=True)])
    taken = taken.agg(F.sum("copies").cast("int").alias(copies)).where(F.col(copies) > 0)
    taken = taken.select(*[F.struct(F.col(c).alias("v")).alias(c) for c in key], copies)  # a struct of null equals another
    own = (F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64(text_or_empty()))
    rows = docs.select("*", *[F.struct(c.alias("v")).alias(k) for c, k in zip(own, key, strict=True)])
    out = rows.dropDuplicates(key).join(taken, key)
    return out.withColumn(f"{p}copy", F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def op10_pareto_mixing(spark, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def oracle(weights: tuple = WEIGHTS, budget: float = 1.5, cap: float = 2.0, seed: int = 7) -> str:
    """DuckDB SQL of the same mix, by one plain window over each source."""
    choice = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(weights))
    return f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         (CAST(CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
           / {U_SCALE} AS u
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {choice} END :: DOUBLE AS weight
  FROM d GROUP BY source),
tries AS (  -- level reached when every source at or below a cap ratio is held at its cap
  SELECT a.source,
         (CAST({budget} AS DOUBLE) * (SELECT sum(source_size) FROM s) - coalesce(sum({cap} * b.source_size), 0.0))
           / ((SELECT sum(weight) FROM s) - coalesce(sum(b.weight), 0.0)) AS level
  FROM s a LEFT JOIN s b ON {cap} * b.source_size / b.weight < {cap} * a.source_size / a.weight
  GROUP BY a.source),
open AS (
  SELECT max(level) AS level FROM s JOIN tries ON s.source IS NOT DISTINCT FROM tries.source
  WHERE {cap} * source_size > level * weight),
t AS (
  SELECT source, source_size, CAST(least(coalesce(open.level * weight, {cap} * source_size), {cap} * source_size) AS DOUBLE) AS target
  FROM s, open),
r AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size - floor(t.target / t.source_size) ELSE 0 END AS pi
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY (u / (1 - u)) / nullif(pi / (1 - pi), 0), doc_id, size
                            ROWS UNBOUNDED PRECEDING) - size AS before FROM r)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN pi > 0 AND before + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM k"""
