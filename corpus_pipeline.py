"""The corpus pipeline: five operators, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents; the last one returns pieces. Documents may
carry more columns than the operators read; they stay with their rows.

1. toxicity    documents scored as toxic go.
2. near_dedup  one document of each class of near duplicates stays: that of the smallest doc_id.
3. suffixes    strings of 200 bytes that repeat are cut out of the texts; every document stays, n_chars is counted anew.
4. mixing      rows are repeated, or left out, as the mix of sources takes them.
5. packing     pieces of power-of-two length.

The first four cannot be expressed in SQL together, so ``ORACLE_SQL`` is None and the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm.common import importable, staged
from quarterdeck.llm.minhash import one_of_each
from quarterdeck.llm.mixing import mixed_rows
from quarterdeck.llm.packing import pack
from quarterdeck.llm.suffix import cut_texts
from quarterdeck.llm.toxicity import without_toxic

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, importable(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return one_of_each(docs)


def suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return cut_texts(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return pack(docs)


STAGES = [(stage.__name__, stage) for stage in (toxicity, near_dedup, suffixes, mixing, packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's result is written as Parquet in the shared folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
