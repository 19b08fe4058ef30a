"""Token-id files of independent zstandard frames with a trailing seek table.

File layout (the public seekable zstandard format, one more frame before the table):

* data frames: the ids of some consecutive documents, little-endian, ``width`` bytes each;
* a directory frame: doc ids (8 bytes, then a null mark of 1 byte) and id counts (8 bytes) of the file's documents;
* a skippable frame ``0x184D2A5E`` with compressed size, size and the low 32 bits of XXH64 of every
  frame, then the number of frames, the descriptor byte (0x80: checksums) and ``0x8F92EAB1``.

Every frame is a complete zstandard frame with its own checksum; a reader fetches the table from the end of the file
and decompresses only the frames whose documents are asked for (``read_ids``).

Scale: ids are made in one pass and cross one shuffle (2 bytes each for vocabularies under 65,536) to
the file of their doc_id range; ranges come from a quantile sketch of the ids alone. A task holds one frame at a
time. The running start of the files comes from a manifest with a row per file.

Defined cases: a null or empty text has the end id alone; null doc_ids come first; repeated doc_ids
stand side by side, by their ids; an empty table writes no file and gives no rows.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterdeck.llm.common import batch_of, checkpointed, remove_on_exit, shuffle_partitions, text_slices, text_or_empty
from quarterdeck.llm.tokens import default_path, encoder
from quarterdeck.plans.storage import staging_path

END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Bytes of ids after which a frame is closed; a document never spans frames.
FRAME_BYTES = 1 << 20
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER = struct.Struct("<III"), struct.Struct("<IBI")
LEVEL = 1


class FrameWriter:
    """Writes one file; ``add`` takes documents in their order."""

    def __init__(self, sink, width: int, level: int = LEVEL):
        self.sink, self.width = sink, width
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        self.table, self.keys, self.counts, self.held, self.size = [], [], [], [], 0

    def _frame(self, data: bytes) -> None:
        packed = self.compress(data)
        self.table.append(ENTRY.pack(len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.sink.write(packed)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.keys.append(doc_id)
        self.counts.append(len(ids) // self.width)
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        null = np.array([k is None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        head = struct.pack("<QQ", len(keys), self.width)
        self._frame(head + keys.tobytes() + null.tobytes() + np.array(self.counts, "<i8").tobytes())
        body = b"".join(self.table) + FOOTER.pack(len(self.table), CHECKSUMS, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(body)) + body)


class FrameReader:
    """Reads one file by its seek table; decompresses frames on demand and checks them."""

    def __init__(self, source):
        self.source, end = source, source.size()
        source.seek(end - FOOTER.size)
        frames, descriptor, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != SEEKABLE or descriptor != CHECKSUMS:
            raise ValueError("no seek table")
        source.seek(end - FOOTER.size - frames * ENTRY.size)
        self.table = np.frombuffer(source.read(frames * ENTRY.size), "<u4").reshape(-1, 3).astype(np.int64)
        self.at = np.cumsum(self.table[:, 0]) - self.table[:, 0]
        self.sizes = self.table[:-1, 1]
        self.decompress = zstandard.ZstdDecompressor().decompress
        data = self.frame(frames - 1)
        n, self.width = struct.unpack_from("<QQ", data)
        null = np.frombuffer(data, np.uint8, n, 16 + 8 * n)
        self.keys = [None if z else int(k) for k, z in zip(np.frombuffer(data, "<i8", n, 16), null, strict=True)]
        self.counts = np.frombuffer(data, "<i8", n, 16 + 9 * n)

    def frame(self, k: int) -> bytes:
        self.source.seek(int(self.at[k]))
        data = self.decompress(self.source.read(int(self.table[k, 0])), max_output_size=int(self.table[k, 1]))
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} fails its checksum")
        return data

    def documents(self, wanted: set | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, ids of the file's documents before it, ids; only frames with wanted documents are read."""
        ends = np.cumsum(self.counts) * self.width
        begins = ends - self.counts * self.width
        frame_ends = np.cumsum(self.sizes)
        frame_of = np.searchsorted(frame_ends, begins, side="right")
        held, data = -1, b""
        for i, key in enumerate(self.keys):
            if wanted is not None and key not in wanted:
                continue
            k = int(frame_of[i])
            if k != held:
                held, data = k, self.frame(k)
            base = int(frame_ends[k] - self.sizes[k])
            ids = np.frombuffer(data, f"<u{self.width}", int(self.counts[i]), int(begins[i]) - base)
            yield key, int(begins[i]) // self.width, ids


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder's address, for tasks; a plain path counts as a mounted folder."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _encode(path: str, end_id: int, width: int, bounds: list[int]):
    schema = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        enc = encoder(path)
        for batch in text_slices(batches, 1):
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            got = [np.append(x, np.uint32(end_id)).astype(f"<u{width}").tobytes() for x in enc.encode(texts)]
            at = [0 if k is None else int(np.searchsorted(bounds, k)) for k in keys.to_pylist()]
            yield batch_of(schema, (at, keys, got))

    return run


def _write(folder: str, width: int):
    schema = pa.schema([("file", pa.string()), ("first", pa.int32()), ("n_documents", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        writer = name = sink = None
        for batch in text_slices(batches, 2):
            for bucket, key, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    fs, top = open_folder(folder)
                    fs.create_dir(top)
                    first, name = bucket, f"{top}/{bucket:07d}-{uuid.uuid4().hex}.ids.zst"  # each attempt has a file of its own
                    sink = fs.open_output_stream(name, compression=None)
                    writer = FrameWriter(sink, width)
                writer.add(key, ids)
        if writer is not None:
            writer.close()
            sink.close()
            row = ([name.rsplit("/", 1)[1]], [first], [len(writer.counts)], [int(sum(writer.counts))])
            yield batch_of(schema, row)

    return run


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, files: int | None = None) -> DataFrame:
    """Write the files; returns the manifest: file, first (its place), n_documents, n_tokens, start (ids before it).

    Only files of the manifest belong to the output; a lost attempt may leave another.
    """
    spark, path = docs.sparkSession, path or default_path(TOKENIZER)
    enc = encoder(path)
    width = 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    files = files or shuffle_partitions(spark)
    cuts = [i / files for i in range(1, files)]
    found = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), cuts, 10 * files)).first()[0] if cuts else None
    bounds = sorted(set(found or []))
    rows = texts.mapInArrow(_encode(path, end_id, width, bounds), "bucket int, doc_id long, ids binary")
    rows = rows.repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    manifest = checkpointed(rows.mapInArrow(_write(folder, width), "file string, first int, n_documents long, n_tokens long"))
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read(folder: str, wanted: set | None):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        fs, top = open_folder(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_input_file(f"{top}/{name}") as source:
                    rows, size = [], 0
                    for key, before, ids in FrameReader(source).documents(wanted):
                        rows.append((key, start + before, len(ids), ids.astype("<u4").tobytes()))
                        size += len(ids)
                        if size > 1 << 20:
                            yield batch_of(schema, zip(*rows, strict=True))
                            rows, size = [], 0
                    if rows:
                        yield batch_of(schema, zip(*rows, strict=True))

    return run


def read_ids(manifest: DataFrame, folder: str, doc_ids: set | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of all or the given documents."""
    files = manifest.select("file", "start").repartition(shuffle_partitions(manifest.sparkSession), "file")
    return files.mapInArrow(_read(folder, doc_ids), "doc_id long, start long, n_tokens long, ids binary")


def digests(rows: DataFrame) -> DataFrame:
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches):
        for b in batches:
            yield batch_of(schema, (*b.columns[:3], [crc32(x.as_py()) for x in b.column(3)]))

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark, "token-frames")
    manifest = write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    remove_on_exit(spark, folder)
    return digests(read_ids(manifest, folder))
