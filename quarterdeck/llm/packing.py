"""Packing by power-of-two decomposition: no sequence crosses documents.

A document's ids are cut into pieces of ``limit`` ids and then into pieces whose lengths are
the binary digits of what is left, longest first. Every piece is a sequence of its own: its length is a power of
two, so it needs no padding, and sequences of equal length share a bucket (a training batch takes
one bucket). ``sequence_id`` numbers the sequences densely, bucket by bucket, longest first.

Scale: one pass over the texts; what is shuffled are piece rows without ids. The numbering
adds the count per (bucket, input partition) of what stands before, from a table with a row for
each such pair.

Defined cases: a null or empty text has the end id alone; repeated rows are packed
each; an empty table gives no rows.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterdeck.llm.common import batch_of, checkpointed, text_slices, text_or_empty
from quarterdeck.llm.tokens import default_path, encoder

LIMIT = 4096
END_ID = 2
#: Bytes of text encoded together (a longer text by itself): the encoder's arrays take many times as much, and a worker keeps its largest.
TEXT_BYTES = 200_000
TOKENIZER = "word_bpe_49k.json"


def piece_lengths(n: int, limit: int = LIMIT) -> list[int]:
    """Powers of two that add up to ``n``, none above ``limit``, longest first."""
    rest = n % limit
    return [limit] * (n // limit) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pieces(path: str, limit: int, end_id: int, keep_ids: bool):
    fields = [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    schema = pa.schema([*fields, ("part", pa.int32()), ("place", pa.int64()), *([("ids", pa.binary())] if keep_ids else [])])

    def run(batches):
        enc, part, placed = encoder(path), TaskContext.get().partitionId(), {}
        for batch in text_slices(batches, 1, TEXT_BYTES):
            rows, texts = [], batch.column(1).to_pylist()
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(texts), strict=True):
                ids, start = np.append(ids, np.uint32(end_id)).astype("<u4"), 0
                for length in piece_lengths(len(ids), limit):
                    piece = ids[start : start + length].tobytes()
                    place = placed.get(length, 0)
                    placed[length] = place + 1
                    row = (doc_id, start, length, crc32(piece), len(ids), part, place)
                    rows.append((*row, piece) if keep_ids else row)
                    start += length
            yield batch_of(schema, zip(*rows, strict=True))

    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, place long"
    return run, kinds + (", ids binary" if keep_ids else "")


def pack(docs: DataFrame, path: str | None = None, limit: int = LIMIT, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """A row per piece; ``keep_ids`` adds the ids as little-endian unsigned 32-bit integers."""
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")
    run, schema = _pieces(path or default_path(TOKENIZER), limit, end_id, keep_ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    pieces = checkpointed(texts.mapInArrow(run, schema))
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part")
    counts = counts.withColumn("earlier", F.sum("n").over(earlier) - F.col("n"))
    longer = counts.groupBy("length").agg(F.sum("n").alias("n"))  # a row per power of two
    longer = longer.select("length", (F.sum("n").over(Window.orderBy(F.desc("length"))) - F.col("n")).alias("longer"))
    first = counts.join(longer, "length").select("length", "part", (F.col("earlier") + F.col("longer")).alias("first"))
    out = pieces.join(first, ["length", "part"])
    return out.select(
        *("doc_id", "start", "length", "ids_crc32", "doc_tokens"),
        (F.col("first") + F.col("place")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []),
    )


def op5_binary_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
