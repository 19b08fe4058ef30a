"""Keyed loads: rows meet the stored ones by key, and only buckets that change are written.

``merge_rows`` loads a batch into a table of a :class:`~quarterdeck.plans.releases.Draft`:

1. The batch is reduced to one row per key (of several the one with the largest values, column by column) and dealt to the table's buckets
   by the hash that the stored rows were dealt by.
2. Every piece of a keyed table has a small table of key bits beside it: a key sets :data:`BITS` bits of one 64-bit word, both chosen by a hash.
   Words of the touched buckets are or-ed together and joined to the batch by (bucket, word). A key whose bits are not all set is
   surely new: its row needs no look at the stored ones.
3. The others are joined to the stored rows of their buckets by key (NULL equals NULL) and are new, changed or unchanged.
4. Buckets with changed rows are rewritten, buckets with new rows only get one more piece, all others keep their files. A batch that
   changes nothing writes nothing and publishes nothing, so loading a file twice is the same as loading it once.

A column that the batch lacks keeps its stored values in changed rows and is NULL in new ones; a new column is NULL in stored rows. Types widen as
in :mod:`quarterdeck.functions.lattice`: stored pieces stay as they are and are cast when read. Only if a *key* column's text
changes by widening is the whole table dealt anew.

At scale: the batch is shuffled, the stored table is not; of it, the touched buckets' rows are read for step 3, the rewritten buckets' for step 4. Size
buckets so that one is some hundred MB. What reaches the driver is a row per touched bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.lattice import WHOLE, as_types, exactly_wider, merged_types, types_of
from quarterdeck.plans.releases import BUCKET, Draft, Piece, Table, bucket_of, rows_of
from quarterdeck.plans.storage import remove_on_exit, staging_path

BITS = 4
KEYS_PER_WORD = 4  # 16 bits a key: about one new key in 300 meets its bits all set


@dataclass(frozen=True)
class Merged:
    """What a load did: rows by kind, batch rows that lost to another of their key, and buckets by treatment."""

    inserted: int = 0
    updated: int = 0
    unchanged: int = 0
    duplicates: int = 0
    rewritten: tuple[int, ...] = ()
    extended: tuple[int, ...] = ()
    #: Keys of inserted and updated rows, where there are any.
    changed: DataFrame | None = None


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys], F.lit(17))


def key_word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(_hash(keys), F.lit(words)).cast("int")


def key_mask(keys: Sequence[str]) -> Column:
    """The bits that a key sets in its word."""
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        six = F.shiftrightunsigned(_hash(keys), 40 + 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), six))
    return mask


def words_for(rows: int) -> int:
    """Words per bucket: a power of two that leaves room for twice the rows."""
    return 1 << max(4, (2 * rows // KEYS_PER_WORD).bit_length())


def write_keys(draft: Draft, pieces: Sequence[Piece], key: tuple[str, ...], deal: tuple[str, ...], buckets: int, words: int) -> tuple[Piece, ...]:
    """Give new pieces (one written folder) their key bits."""
    if not pieces:
        return ()
    folder = pieces[0].path.rsplit("/", 1)[0]
    rows = rows_of(draft.spark, draft.store.root, Table({k: pieces[0].columns[k] for k in key}), [replace(p, columns={k: p.columns[k] for k in key}) for p in pieces])
    bits = rows.groupBy(bucket_of(deal, buckets).alias(BUCKET), key_word(key, words).alias("word")).agg(F.bit_or(key_mask(key)).alias("bits"))
    bits.repartition(BUCKET).sortWithinPartitions(BUCKET, "word").write.partitionBy(BUCKET).parquet(f"{draft.store.root}/{folder}-keys")
    draft.written.append(f"{folder}-keys")
    return tuple(replace(p, keys=f"{folder}-keys/{BUCKET}={p.bucket}") for p in pieces)


def stored_words(draft: Draft, pieces: Sequence[Piece]) -> DataFrame:
    """Bucket, word, bits of the pieces' keys: one scan, the bucket read from the folder's name."""
    schema = "word int, bits long"
    words = draft.spark.read.schema(schema).parquet(*[f"{draft.store.root}/{p.keys}" for p in pieces])
    bucket = F.regexp_extract(F.col("_metadata.file_path"), BUCKET + r"=(\d+)/[^/]*$", 1).cast("int")
    return words.select(bucket.alias(BUCKET), "word", "bits")


def create(draft: Draft, name: str, df: DataFrame, key: Sequence[str], buckets: int, deal_by: Sequence[str] = ()) -> Table:
    """A keyed table of rows whose keys are unique, dealt to buckets by the key or by some columns of it."""
    key, deal = tuple(key), tuple(deal_by or key)
    pieces = draft.write_pieces(name, df, deal, buckets, key)
    words = words_for(max((p.rows for p in pieces), default=0))
    table = Table(types_of(df), write_keys(draft, pieces, key, deal, buckets, words), key, buckets, words, deal)
    return draft.set(name, table)


def one_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key, the one with the largest values in column order, and how many there were (``__rows``)."""
    rest = [c for c in df.columns if c not in key]
    largest = F.max(F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias("__end"))).alias("__row")
    one = df.groupBy(*[f"`{k}`" for k in key]).agg(largest, F.count(F.lit(1)).alias("__rows"))
    return one.select(*[F.col(f"`{c}`") if c in key else F.col(f"__row.`{c}`").alias(c) for c in df.columns], "__rows")


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    remove_on_exit(df.sparkSession, path)
    return df.sparkSession.read.parquet(path)


def _widened(draft: Draft, name: str, table: Table, target: Mapping[str, str]) -> Table:
    """The stored table under new columns; dealt anew only if a key column changes in a way that changes its text."""
    if any(table.columns[k] != target[k] and target[k] != "string" and not {table.columns[k], target[k]} <= set(WHOLE) for k in table.key):
        rows = draft.read(name)
        return create(draft, name, rows.select(*as_types(rows, target)), table.key, table.buckets, table.deal)
    return replace(table, columns=dict(target))


def merge_rows(draft: Draft, name: str, df: DataFrame, key: Sequence[str] = ("ticker", "report_date"), buckets: int = 32, deal_by: Sequence[str] = ()) -> Merged:
    """Insert or update ``df``'s rows by key; a missing table is created with ``buckets`` buckets. See the module.

    ``deal_by`` names the key columns whose hash gives the bucket (all by default). Dealing by ticker alone keeps a ticker's reports together; a
    ticker then fills at most one row per report date of one bucket.
    """
    spark, root = draft.spark, draft.store.root
    table = draft.tables.get(name)
    key = table.key if table else tuple(key)
    lacking = [k for k in key if k not in df.columns]
    if lacking or (table and not table.words):
        raise ValueError(f"{name}: " + (f"key columns missing: {lacking}" if lacking else "the table has no key"))
    batch = _staged(one_per_key(df, key), f"{name}-batch")
    total = batch.agg(F.sum("__rows"), F.count(F.lit(1))).first()
    duplicates = (total[0] or 0) - total[1]
    batch = batch.drop("__rows")
    if table is None:
        created = create(draft, name, batch, key, buckets, deal_by)
        return Merged(inserted=created.rows, duplicates=duplicates, extended=tuple(p.bucket for p in created.pieces), changed=batch.select(*key) if created.rows else None)
    target = merged_types(table.columns, types_of(batch))
    if target != table.columns:
        stored = rows_of(spark, root, table)
        target = exactly_wider([(stored, table.columns), (batch, types_of(batch))], target)
    before = table
    table = _widened(draft, name, table, target)
    own = batch.columns
    batch = batch.select(*as_types(batch, target)).withColumn(BUCKET, bucket_of(table.deal, table.buckets))
    touched = {r[0] for r in batch.select(BUCKET).distinct().collect()}

    # Keys whose bits are not all set are new.
    near = [p for p in table.pieces if p.bucket in touched]
    if near:
        words = stored_words(draft, near).groupBy(BUCKET, "word").agg(F.bit_or("bits").alias("bits"))
        placed = batch.withColumn("word", key_word(key, table.words)).withColumn("__mask", key_mask(key))
        known = F.coalesce(F.col("bits").bitwiseAND(F.col("__mask")) == F.col("__mask"), F.lit(False))
        batch = placed.join(words, [BUCKET, "word"], "left").withColumn("__known", known).drop("word", "bits", "__mask")
    else:
        batch = batch.withColumn("__known", F.lit(False))
    batch = _staged(batch, f"{name}-placed")

    # Those that may be stored meet their buckets' rows.
    maybe = batch.where("__known")
    look = {r[0] for r in maybe.select(BUCKET).distinct().collect()}
    stored = rows_of(spark, root, table, [p for p in table.pieces if p.bucket in look])
    there = stored.select(F.struct(*[F.col(f"`{c}`") for c in target]).alias("__stored"), *[F.col(f"`{k}`").alias(f"__key{i}") for i, k in enumerate(key)])
    same_key = [F.col(f"`{k}`").eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(key)]
    met = maybe.join(there, same_key, "left").drop(*[f"__key{i}" for i in range(len(key))])
    old = F.col("__stored")
    merged = [F.col(f"`{c}`") if c in own else old[c].alias(c) for c in target]
    differs = F.exists(F.array(*[~F.col(f"`{c}`").eqNullSafe(old[c]) for c in own]), lambda d: d)
    kind = F.when(old.isNull(), F.lit("new")).when(differs, F.lit("changed")).otherwise(F.lit("same"))
    sorted_out = met.select(*merged, BUCKET, kind.alias("__kind")).unionByName(batch.where(~F.col("__known")).select(*[F.col(f"`{c}`") for c in target], BUCKET, F.lit("new").alias("__kind")))
    sorted_out = _staged(sorted_out, f"{name}-sorted-out")
    counts = {(r[BUCKET], r["__kind"]): r["count"] for r in sorted_out.groupBy(BUCKET, "__kind").count().collect()}

    def of(kind: str) -> int:
        return sum(n for (_, k), n in counts.items() if k == kind)

    full = {p.bucket for p in near if sum(q.rows for q in table.pieces if q.bucket == p.bucket) > 2 * table.words * KEYS_PER_WORD}
    rewritten = sorted({b for b, k in counts if k == "changed"})
    extended = sorted({b for b, k in counts if k == "new"} - set(rewritten))
    news = sorted_out.where(F.col("__kind") != "same").select(*[F.col(f"`{k}`") for k in key]) if rewritten or extended else None
    result = Merged(of("new"), of("changed"), of("same"), duplicates, tuple(rewritten), tuple(extended), news)
    if not rewritten and not extended:
        if table != before:
            draft.set(name, table)
        return result
    fresh = sorted_out.where(F.col("__kind") != "same").drop("__kind", BUCKET)
    if rewritten:
        kept = rows_of(spark, root, table, [p for p in table.pieces if p.bucket in rewritten])
        gone = sorted_out.where(F.col("__kind") == "changed").select(*[F.col(f"`{k}`").alias(f"__key{i}") for i, k in enumerate(key)])
        fresh = fresh.unionByName(kept.join(gone, same_key, "left_anti"))
    pieces = write_keys(draft, draft.write_pieces(name, fresh, table.deal, table.buckets, key), key, table.deal, table.buckets, table.words)
    left = tuple(p for p in table.pieces if p.bucket not in rewritten)
    table = draft.set(name, replace(table, pieces=left + pieces))
    if full:  # the words are crowded: deal the whole table anew with more of them
        create(draft, name, draft.read(name), key, table.buckets, table.deal)
    return result
