"""Token ids in seekable zstandard files.

A file holds independent zstandard frames. A document has one frame, or several if it is
long, and no frame holds ids of two documents, so a reader decompresses what it was asked
for and nothing else. Behind them lie two skippable frames: the document table (ids, null
marks, numbers of frames) and, at the very end, the seek table with each frame's compressed
and uncompressed size and a checksum. Tools that know the seekable format read it as well.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyfold.llm.tokens import WordTokens

# Fixed values of the seekable zstandard format.
SKIPPABLE_MAGIC = 0x184D2A50
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

# Ids in one frame at most.
FRAME_IDS = 1 << 16

_MANIFEST = "file string, n_docs long, n_ids long, min_id long, max_id long, has_null boolean"


def _sum32(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Writes documents' ids to an open binary file, one after the other."""

    def __init__(self, sink, wide: bool, level: int = 3):
        self._sink, self._type = sink, "<u4" if wide else "<u2"
        self._compress = zstandard.ZstdCompressor(level=level).compress
        self._entries: list[tuple[int, int, int]] = []
        self._documents: list[tuple[int, int, int]] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frames = range(0, max(1, len(ids)), FRAME_IDS)
        for at in frames:
            data = ids[at : at + FRAME_IDS].astype(self._type).tobytes()
            packed = self._compress(data)
            self._sink.write(packed)
            self._entries.append((len(packed), len(data), _sum32(data)))
        self._documents.append((doc_id or 0, doc_id is None, len(frames)))
        self.n_ids += len(ids)

    def close(self) -> None:
        table = struct.pack("<QB", len(self._documents), int(self._type[-1]))
        for kind, column in zip(("<i8", "u1", "<u4"), zip(*self._documents)):
            table += np.array(column, kind).tobytes()
        self._sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self._entries.append((8 + len(table), 0, _sum32(b"")))
        seek = np.array(self._entries, "<u4").tobytes()
        seek += struct.pack("<IBI", len(self._entries), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self._sink.write(struct.pack("<II", SEEK_TABLE_MAGIC, len(seek)) + seek)


class FrameReader:
    """Reads single documents of a file; ``source`` is an open random-access file."""

    def __init__(self, source):
        self._source, size = source, source.size()
        n, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        table = source.read_at(12 * n, size - 9 - 12 * n)
        self._entries = np.frombuffer(table, "<u4").reshape(n, 3)
        self._starts = np.concatenate([[0], np.cumsum(self._entries[:, 0], dtype=np.int64)])
        head = source.read_at(int(self._entries[-1, 0]), int(self._starts[-2]))
        docs, width = struct.unpack("<QB", head[8:17])
        self._type = f"<u{width}"
        self.doc_ids = np.frombuffer(head, "<i8", docs, 17)
        self.null = np.frombuffer(head, "u1", docs, 17 + 8 * docs).astype(bool)
        frames = np.frombuffer(head, "<u4", docs, 17 + 9 * docs)
        self._first = np.concatenate([[0], np.cumsum(frames, dtype=np.int64)])
        sizes = np.concatenate([[0], np.cumsum(self._entries[:, 1], dtype=np.int64)])
        self.starts = sizes[self._first] // width
        self._decompress = zstandard.ZstdDecompressor().decompress

    def ids(self, k: int) -> np.ndarray:
        """Ids of the file's k-th document, checked against the seek table."""
        a, b = int(self._first[k]), int(self._first[k + 1])
        start = int(self._starts[a])
        raw, parts = self._source.read_at(int(self._starts[b]) - start, start), []
        for frame in range(a, b):
            at = int(self._starts[frame]) - start
            packed, plain, expected = map(int, self._entries[frame])
            data = self._decompress(raw[at : at + packed], max_output_size=max(1, plain))
            if len(data) != plain or _sum32(data) != expected:
                raise ValueError(f"frame {frame} does not match its checksum")
            parts.append(data)
        return np.frombuffer(b"".join(parts), self._type).astype("<u4")


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_tokens(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every text, add the end id, and write files in ascending document order.

    Documents are ranged by id, so file k holds smaller ids than file k + 1; null ids come
    first, and rows of one id are ordered by text. A task writes under a name of its own
    and renames the finished file, so a repeated task leaves one whole file. ``folder`` is
    one that all executors share. Null and empty texts hold the end id alone; an empty
    table gives no files.

    Returns the manifest, also written to the folder: a row per file with its totals.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(folder)
        encoder, end = WordTokens.shared(path), int(end_id).to_bytes(4, "little")
        name = f"part-{TaskContext.get().partitionId():06d}.zst"
        own = f"{root}/{name}.{uuid.uuid4().hex}"
        sink = writer = None
        lowest = highest = None
        n_docs, has_null = 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                sink = store.open_output_stream(own, compression=None)
                writer = FrameWriter(sink, encoder.wide or end_id > 0xFFFF)
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1))):
                writer.add(doc_id, np.frombuffer(ids + end, "<u4"))
                n_docs += 1
                if doc_id is None:
                    has_null = True
                else:
                    lowest = doc_id if lowest is None else lowest
                    highest = doc_id
        if writer is None:
            return
        writer.close()
        sink.close()
        store.move(own, f"{root}/{name}")
        row = [name, n_docs, writer.n_ids, lowest, highest, has_null]
        kinds = [pa.string(), *[pa.int64()] * 4, pa.bool_()]
        names = ["file", "n_docs", "n_ids", "min_id", "max_id", "has_null"]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    store, root = _opened(folder)
    store.create_dir(root, recursive=True)
    order = F.col("_id").asc_nulls_first()
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")
    )
    ranged = rows.repartitionByRange(order).sortWithinPartitions(order, "_text")
    ranged.mapInArrow(run, _MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with each file's first position; one row per file."""
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _spread(files: DataFrame) -> DataFrame:
    """One file per task, as far as there are tasks."""
    count = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(count, "file")


def _reader(folder: str, wanted: Sequence[int] | None, digest: bool):
    names = ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"]
    last = pa.int64() if digest else pa.list_(pa.int64())
    pick = None if wanted is None else np.array(sorted(wanted), "<i8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(folder)
        for batch in batches:
            for name, base in zip(*(column.to_pylist() for column in batch.columns)):
                with store.open_input_file(f"{root}/{name}") as source:
                    file = FrameReader(source)
                    if pick is None:
                        chosen = np.arange(len(file.doc_ids))
                    else:
                        chosen = np.flatnonzero(np.isin(file.doc_ids, pick) & ~file.null)
                    for at in range(0, len(chosen), 512):
                        rows = []
                        for k in chosen[at : at + 512].tolist():
                            ids = file.ids(k)
                            doc_id = None if file.null[k] else int(file.doc_ids[k])
                            value = zlib.crc32(ids.tobytes()) if digest else ids.tolist()
                            rows.append((doc_id, base + int(file.starts[k]), len(ids), value))
                        kinds = [pa.int64()] * 3 + [last]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
                        )

    return run


def read_tokens(
    spark: SparkSession, folder: str, doc_ids: Sequence[int] | None = None
) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all documents, or of the given ones only.

    Given ids must be few enough to pass to every task. Files whose range of ids holds none
    of them are not opened, and of the others only the frames asked for are read.
    """
    files = _files(spark, folder)
    if doc_ids is not None:
        asked = F.array(*[F.lit(int(i)).cast("long") for i in doc_ids]).cast("array<long>")
        files = files.filter(
            F.exists(asked, lambda i: (i >= F.col("min_id")) & (i <= F.col("max_id")))
        )
    schema = "doc_id long, start long, n_tokens long, ids array<long>"
    return _spread(files.select("file", "base")).mapInArrow(
        _reader(folder, doc_ids, False), schema
    )


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, read back from the files.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is that of all its
    ids as little-endian unsigned 32-bit integers.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    files = _files(spark, folder).select("file", "base")
    return _spread(files).mapInArrow(_reader(folder, None, True), schema)
