"""Documents to the four statement files in one step.

The sections are unpivoted once, into one staged table by section; one aggregate over it gives the line items of all
sections (their number bounds what reaches the driver: the columns of a table), and every document's reports are widened, typed leniently and written as tab-separated files. Documents without a ticker
and reports without any value stay rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.operators.reshape import company_profile, records_long, statement_long, statement_wide
from quarterdeck.plans.storage import remove_on_exit, staging_path
from quarterdeck.schemas import FULL_PROFILE_ATTRIBUTES, SECTIONS
from quarterdeck.sources.delimited import write_delimited
from quarterdeck.sources.documents import with_document


def statement_tables_of(docs: DataFrame, shape: str = "map", sections=SECTIONS) -> dict[str, DataFrame]:
    """Wide, typed statement tables of the documents, columns in order of their names."""
    docs = docs if "document" in docs.columns else with_document(docs)
    unpivot = {"map": statement_long, "records": records_long}[shape]
    spark, place = docs.sparkSession, staging_path(docs.sparkSession, "sections")
    remove_on_exit(spark, place)
    parts = [unpivot(docs, section, keep_missing=True).withColumn("section", F.lit(section)) for section in sections]
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    long.write.partitionBy("section").parquet(place)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in long.schema.fields)
    long = spark.read.schema(schema).parquet(place)
    items: dict[str, list[str]] = {section: [] for section in sections}
    for r in long.groupBy("section", "line_item").agg(F.lit(1)).collect():  # the columns of the tables
        items[r["section"]].append(r["line_item"])
    of = {section: long.where(F.col("section") == section).drop("section") for section in sections}
    return {section: statement_wide(of[section], sorted(items[section]), section).drop("document") for section in sections}


def export_documents(docs: DataFrame, folder: str, shape: str = "map", sections=SECTIONS) -> dict[str, str]:
    """Write ``<folder>/<section>.csv`` for every section and, for map-shaped documents, ``company_info.csv``.

    Returns the path of every file written.
    """
    tables = statement_tables_of(docs, shape, sections)
    if shape == "map":
        tables["company_info"] = company_profile(docs.where("company_info IS NOT NULL"), FULL_PROFILE_ATTRIBUTES)
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}.csv"
        write_delimited(df, paths[name])
    return paths
