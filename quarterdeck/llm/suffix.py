"""Removal of repeated byte strings by suffix sorting with external induction.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the input. The result
is exact, whatever the number of repeats.

1. Anchors (``anchors``): every string of ``LENGTH`` bytes has an anchor chosen by its own bytes, so equal strings share
   the anchor's bytes and offset. A first pass counts anchors; only those met twice or more matter.
2. A second pass cuts the text around such anchors into pieces: the strings' starts that chose an anchor,
   each start in exactly one piece. Equal pieces are counted, not compared: all their strings repeat.
3. Anchors with several different pieces form groups; one copy of each of their pieces goes to the shard of its anchor, whose
   suffixes are sorted by external induced sorting (``induction``). Neighbours with ``LENGTH`` bytes in
   common mark the strings that repeat.
4. Marked starts go back to all occurrences, are joined to spans per document, and the spans are cut out.

Scale: the texts cross a shuffle twice at most, and only those documents that hold such pieces. Pieces are counted with
map-side combining, so thousands of copies are one row per task. Shards are streamed, as many small groups or one large one at a
time; induction spills to disk. A group with more than ``HOT`` different pieces is split: its starts are divided into slices of
``SLICE``, keyed by the bytes that all strings of a slice share, and equal slices are counted first. Documents are
identified by doc_id and a hash of the text.

Defined cases: a null text is empty; rows with equal doc_id and text are documents of their own, so all their strings
repeat; null doc_ids are as good as others; texts shorter than ``LENGTH`` bytes are kept whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.anchors import GRAM, Hasher, anchors
from quarterdeck.llm.bits import bitmap, passes, with_bits
from quarterdeck.llm.common import batch_of, free_prefix, scratch_folder, shuffle_partitions, staged, text_or_empty, text_slices
from quarterdeck.llm.induction import Shard
from quarterdeck.llm.shingles import MIX, scramble

LENGTH = 200
#: Pieces of one group beyond which it is split, pieces sorted at a time in memory, starts in a slice.
HOT, IN_MEMORY, SLICE = 50_000, 1 << 14, 16
NO_ID = -(1 << 63)
#: Bytes of text that a task looks at together (a longer text by itself).
TEXT_BYTES = 200_000
#: A piece's place in one number: first start, number of starts and the anchor's distance from the first (both below 2**12).


def _place(first: np.ndarray, n: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return (first << 24) | (n << 12) | anchor


FIRST, STARTS, ANCHOR = "shiftright(place, 24)", "(shiftright(place, 12) & 4095)", "(place & 4095)"


def identified(docs: DataFrame) -> DataFrame:
    """doc, mark (which identify a document), doc_id and the text's bytes."""
    text = text_or_empty()
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("mark"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text.cast("binary").alias("text"),
    )


def anchor_counts(texts: DataFrame, length: int) -> DataFrame:
    """key of every anchor, and how many a batch of texts has."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(batches):
        hasher = Hasher()
        for batch in text_slices(batches, 0, TEXT_BYTES):
            found = anchors(batch.column(0).to_pylist(), length, hasher)[1]
            if len(found):
                keys, n = np.unique(found, return_counts=True)
                yield batch_of(schema, (keys.view(np.int64), n))

    return texts.select("text").mapInArrow(run, "key long, n long")


def occurrences(texts: DataFrame, length: int, bits, hot: frozenset | None = None) -> DataFrame:
    """key, piece (hashes), doc, mark, place of every piece whose anchor passes ``bits``.

    With ``hot``, only those anchors' pieces, in slices of ``SLICE`` starts at fixed distances from the anchor, under
    a key of the bytes that a slice's strings share.
    """
    names = ("key", "piece", "doc", "mark", "place")
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches):
        hasher = Hasher()
        for batch in text_slices(batches, 2, TEXT_BYTES):
            raw = batch.column(2).to_pylist()
            of, key, spot, first, n = anchors(raw, length, hasher)
            kept = passes(bits.value, key)
            if hot is not None:
                kept &= np.isin(key.view(np.int64), np.fromiter(hot, np.int64, len(hot)))
            if not kept.any():
                continue
            of, key, spot, first, n = (x[kept] for x in (of, key, spot, first, n))
            begins = np.cumsum([0, *map(len, raw)])[of]
            sums = hasher.sums(np.frombuffer(b"".join(raw), np.uint8))
            if hot is not None:
                # Distances of starts to the anchor run from spot - first down; slices are blocks of distances.
                far, near = spot - first, spot - first - n + 1
                parts = far // SLICE - near // SLICE + 1
                row = np.repeat(np.arange(len(of)), parts)
                block = far[row] // SLICE - (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts))
                high, low = np.minimum(far[row], block * SLICE + SLICE - 1), np.maximum(near[row], block * SLICE)
                of, key, spot, begins = of[row], key[row], spot[row], begins[row]
                first, n = spot - high, high - low + 1
                shared = hasher.of(sums, begins + spot - block * SLICE, begins + spot - block * SLICE - SLICE + 1 + length)
                key = scramble(key ^ (block.astype(np.uint64) * MIX) ^ scramble(shared))
            piece = hasher.of(sums, begins + first, begins + first + n + length - 1) ^ scramble(n.astype(np.uint64) + (first - spot).astype(np.uint64) * MIX)
            where = pa.array(of)
            yield batch_of(schema, (key.view(np.int64), piece.view(np.int64), batch.column(0).take(where), batch.column(1).take(where), _place(first, n, spot - first)))

    return texts.select("doc", "mark", "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def cut_pieces(texts: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """key, piece, anchor and bytes of the chosen occurrences."""
    spark = texts.sparkSession
    held = spark.sparkContext.broadcast(bitmap(chosen, "mark"))
    wanted = chosen.groupBy("doc", "mark").agg(F.collect_list(F.struct("key", "piece", "place")).alias("cuts"))
    rows = with_bits(texts.select("doc", "mark", "text"), held, True).dropDuplicates(["doc", "mark"]).join(wanted, ["doc", "mark"])
    return rows.select("text", F.explode("cuts").alias("cut")).select("text", "cut.*").select(
        "key",
        "piece",
        F.expr(f"cast({ANCHOR} as int)").alias("anchor"),
        F.expr(f"substring(text, cast({FIRST} as int) + 1, cast({STARTS} as int) + {length - 1})").alias("bytes"),
    )


def induced_runs(pieces: DataFrame, length: int, in_memory: int) -> DataFrame:
    """key, piece and the runs of starts that repeat, by suffix sorting of whole groups in shards."""
    run_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("key", pa.int64()), ("piece", pa.int64()), ("runs", run_type)])
    left = length - GRAM  # the anchor is at most so far from a start

    def finish(shard: Shard, names: list, places: list):
        marks = shard.repeated(length)
        for lo in range(0, len(names), in_memory):
            part = np.asarray(marks[:, lo : lo + in_memory]).T
            edge = np.diff(np.pad(part, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            (row, begin), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
            out: dict[int, list] = {}
            for r, b, e in zip(row.tolist(), begin.tolist(), end.tolist(), strict=True):
                shift = left - places[lo + r]
                out.setdefault(r, []).append({"begin": b - shift, "end": e - shift})
            if out:
                keys = [names[lo + r] for r in out]
                yield batch_of(schema, ([k for k, _ in keys], [p for _, p in keys], list(out.values())))

    def run(batches):
        with scratch_folder() as folder:
            shard, names, places, groups, last = Shard(left, length, folder, in_memory), [], [], -1, None
            for batch in text_slices(batches, 3):
                for key, piece, anchor, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if key != last:
                        if len(names) >= in_memory:
                            yield from finish(shard, names, places)
                            shard, names, places, groups = Shard(left, length, folder, in_memory), [], [], -1
                        groups, last = groups + 1, key
                    shard.add(groups, data, anchor)
                    names.append((key, piece))
                    places.append(anchor)
            if names:
                yield from finish(shard, names, places)

    by_group = pieces.repartition(shuffle_partitions(pieces.sparkSession), "key").sortWithinPartitions("key")
    return by_group.mapInArrow(run, "key long, piece long, runs array<struct<begin: int, end: int>>")


def repeated_spans(texts: DataFrame, length: int = LENGTH, hot: int = HOT, in_memory: int = IN_MEMORY) -> DataFrame:
    """doc, mark and spans: the bytes [begin, end) to remove of every document that has any; spans are disjoint."""
    sc = texts.sparkSession.sparkContext
    counts = anchor_counts(texts, length).groupBy("key").agg(F.sum("n").alias("n"))
    bits = sc.broadcast(bitmap(counts.where("n > 1"), "key"))
    found = staged(occurrences(texts, length, bits), "suffix-occurrences")
    distinct = lambda rows: rows.groupBy("key", "piece").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "mark", "place")).alias("one")
    )
    kinds = staged(distinct(found), "suffix-pieces")
    groups = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("pieces"))
    over = groups.where(F.col("pieces") > hot).select("key").collect()  # each stands for over ``hot`` pieces
    if over:
        hot_keys = frozenset(r["key"] for r in over)
        table = texts.sparkSession.createDataFrame([(k,) for k in hot_keys], "key long")
        found = found.join(F.broadcast(table), "key", "left_anti").unionByName(occurrences(texts, length, bits, hot_keys))
        found = staged(found, "suffix-occurrences")
        kinds = staged(distinct(found), "suffix-pieces")
        groups = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("pieces"))
    several = kinds.join(groups.where("pieces > 1").select("key"), "key").select("key", "piece", "one.*")
    runs = induced_runs(cut_pieces(texts, staged(several, "suffix-several"), length), length, in_memory)
    starts = F.expr(STARTS.replace("place", "one.place")).cast("int")
    whole = kinds.where("copies > 1").select("key", "piece", F.array(F.struct(F.lit(0).alias("begin"), starts.alias("end"))).alias("runs"))
    part = runs.join(kinds.where("copies > 1").select("key", "piece"), ["key", "piece"], "left_anti")
    marked = staged(whole.unionByName(part), "suffix-runs")
    starts = found.join(marked, ["key", "piece"]).select("doc", "mark", F.expr(f"cast({FIRST} as int)").alias("first"), F.explode("runs").alias("run"))
    starts = starts.select("doc", "mark", F.struct((F.col("first") + F.col("run.begin")).alias("begin"), (F.col("first") + F.col("run.end") + length - 1).alias("end")).alias("span"))
    each = starts.groupBy("doc", "mark").agg(F.collect_set("span").alias("spans"))  # as many as a text has anchors
    return each.mapInArrow(_joined, "doc long, mark long, spans array<struct<begin: int, end: int>>")


def _joined(batches):
    """Spans in order, those that touch joined to one; by arrays, since a batch holds hundreds of thousands."""
    for batch in batches:
        lists = batch.column(2)
        flat, of = lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        begin, end = (flat.field(c).to_numpy().astype(np.int64) for c in ("begin", "end"))
        order = np.lexsort((begin, of))
        base = of * (int(end.max(initial=0)) + 1)  # of a row; keeps the rows' spans apart and ``of`` is sorted already
        begin, reach = base + begin[order], np.maximum.accumulate(base + end[order])
        new = np.ones(len(order), bool)
        new[1:] = begin[1:] > reach[:-1]
        last = np.append(new[1:], True)[: len(new)]
        kind = lists.type
        spans = [pa.array(x, pa.int32()) for x in (begin[new] - base[new], reach[last] - base[last])]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(of[new], minlength=len(lists)))])
        done = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(spans, fields=list(kind.value_type)), type=kind)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), done], names=batch.schema.names)


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, in_memory: int = IN_MEMORY) -> DataFrame:
    """doc_id, mark, text (bytes), spans (null if none) of every row."""
    texts = identified(docs)
    spans = staged(repeated_spans(texts, length, hot, in_memory), "suffix-spans")
    held = texts.sparkSession.sparkContext.broadcast(bitmap(spans, "mark"))
    kept = with_bits(texts, held, False)
    kept = kept.withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    cut = with_bits(texts, held, True).join(spans, ["doc", "mark"], "left")
    return kept.unionByName(cut).select("doc_id", "mark", "text", "spans")


def cut_texts(docs: DataFrame, length: int = LENGTH, hot: int = HOT, in_memory: int = IN_MEMORY) -> DataFrame:
    """The rows of ``docs``, all columns, with repeated strings cut out of text and n_chars (if there is one) counted anew.

    A cut inside a character drops what is left of it. Null texts stay null. Rows without repeats do not move.
    """
    texts = identified(docs)
    spans = staged(repeated_spans(texts, length, hot, in_memory), "suffix-spans")
    held = docs.sparkSession.sparkContext.broadcast(bitmap(spans, "mark"))
    at = docs.columns.index("text")
    p = free_prefix(docs.columns)
    doc, mark, cuts_of = f"{p}doc", f"{p}mark", f"{p}spans"
    ids = docs.withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(mark, F.xxhash64(text_or_empty()))
    kept = with_bits(ids, held, False, mark).select(*docs.columns)
    # Merged, never broadcast: a shuffle parts the two passes in Python, else each task holds two workers, and those stay with the executor.
    spans = spans.select(F.col("doc").alias(doc), F.col("mark").alias(mark), F.col("spans").alias(cuts_of)).hint("merge")
    found = with_bits(ids, held, True, mark).join(spans, [doc, mark], "left")

    def run(batches):
        for batch in text_slices(batches, at):
            new = []
            for text, cuts in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                new.append(text if not cuts else kept_bytes(text.encode(), cuts).decode(errors="ignore"))
            columns = [pa.array(new, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    found = found.select(*docs.columns, cuts_of).mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return kept.unionByName(found)


def kept_bytes(text: bytes, spans: list | None) -> bytes:
    if not spans:
        return text
    out, at = [], 0
    for s in spans:
        out.append(text[at : s["begin"]])
        at = s["end"]
    return b"".join([*out, text[at:]])


def _digest(batches):
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")], ("kept_sha256", pa.string())])
    for batch in text_slices(batches, 1):
        texts, spans = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        left = [kept_bytes(t, s) for t, s in zip(texts, spans, strict=True)]
        yield batch_of(
            schema,
            (
                batch.column(0),
                [len(t) for t in texts],
                [len(t) - len(k) for t, k in zip(texts, left, strict=True)],
                [len(s or ()) for s in spans],
                [hashlib.sha256(k).hexdigest() for k in left],
            ),
        )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text", "spans")
    return out.mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
