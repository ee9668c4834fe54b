"""Token ids in seekable files: independent zstandard frames, a document
index and a trailing seek table with a checksum for every frame.

A file is a valid zstandard stream in the public seekable layout:

* data frames, each an independent zstandard frame of the little-endian
  unsigned 32-bit ids of one document (a long document has several);
* a skippable frame (0x184D2A50) with one fixed-size record per document:
  doc_id, whether it is set, id count, first frame, frame count;
* the seek table, a skippable frame (0x184D2A5E): compressed size, plain size
  and the low 32 bits of XXH64 of the plain bytes for every frame above, then
  the frame count, a descriptor byte and 0x8F92EAB1.

A reader opens the end of the file, then decompresses the frames of the
documents asked for and no others.

``write`` range-partitions the documents by doc_id, so the files in order of
their names hold all documents in ascending doc_id order (null first, ties by
a hash of the text).  A task writes under a temporary name and renames, so a
retried task leaves a whole file of the same content.  Files are reached by
URI through pyarrow's file systems.

Null text counts as empty; an empty table gives no files; other columns are
ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_path, slices, take, written
from .tokens import CACHE_CHUNKS, encoder, tokenizer_path

END_ID = 2
LEVEL = 3
FRAME_IDS = 1 << 18  # ids in one frame at most
SLICE = 1 << 18      # bytes of text encoded at once

_INDEX_MAGIC, _TABLE_MAGIC, _SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_RECORD = np.dtype([("doc_id", "<i8"), ("set", "u1"), ("ids", "<u8"),
                    ("first", "<u4"), ("frames", "<u4")])
_ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])

FILE_SCHEMA = "part int, file string, documents long, ids long"
DOCUMENT_SCHEMA = "doc_id long, start long, ids binary"


def _check(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class TokenFileWriter:
    """Writes documents to a binary stream."""

    def __init__(self, sink, level: int = LEVEL, frame_ids: int = FRAME_IDS):
        import zstandard

        self.sink, self.frame_ids = sink, frame_ids
        self.zip = zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple] = []
        self.records: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        first = len(self.entries)
        for at in range(0, len(ids), self.frame_ids):
            plain = ids[at:at + self.frame_ids].astype("<u4", copy=False).tobytes()
            packed = self.zip.compress(plain)
            self.sink.write(packed)
            self.entries.append((len(packed), len(plain), _check(plain)))
        self.records.append((doc_id or 0, doc_id is not None, len(ids), first,
                             len(self.entries) - first))

    def finish(self) -> None:
        index = np.array(self.records, _RECORD).tobytes()
        self.sink.write(struct.pack("<II", _INDEX_MAGIC, len(index)) + index)
        self.entries.append((8 + len(index), 0, _check(b"")))
        table = np.array(self.entries, _ENTRY).tobytes() + struct.pack(
            "<IBI", len(self.entries), 0x80, _SEEKABLE)
        self.sink.write(struct.pack("<II", _TABLE_MAGIC, len(table)) + table)


class TokenFileReader:
    """Random access to a file of ``TokenFileWriter`` (any seekable binary file)."""

    def __init__(self, source):
        import zstandard

        self.source = source
        self.unzip = zstandard.ZstdDecompressor()
        size = source.seek(0, 2)
        frames, mark, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != _SEEKABLE or mark != 0x80:
            raise ValueError("not a token file: no seek table at its end")
        table = size - 9 - frames * _ENTRY.itemsize
        self.entries = np.frombuffer(self._at(table, frames * _ENTRY.itemsize), _ENTRY)
        self.offsets = np.concatenate([[0], np.cumsum(self.entries["packed"].astype(np.int64))])
        if struct.unpack("<I", self._at(table - 8, 4))[0] != _TABLE_MAGIC \
                or self.offsets[-1] != table - 8:
            raise ValueError("damaged seek table")
        index = self._at(int(self.offsets[-2]), int(self.entries["packed"][-1]))
        magic, length = struct.unpack("<II", index[:8])
        if magic != _INDEX_MAGIC:
            raise ValueError("damaged document index")
        self.documents = np.frombuffer(index[8:8 + length], _RECORD)
        self.starts = np.concatenate([[0], np.cumsum(self.documents["ids"].astype(np.int64))])

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def ids(self, row: int) -> bytes:
        """The ids of the document at this row of the index, frames checked."""
        r = self.documents[row]
        out = []
        for k in range(int(r["first"]), int(r["first"]) + int(r["frames"])):
            e = self.entries[k]
            plain = self.unzip.decompress(self._at(int(self.offsets[k]), int(e["packed"])),
                                          max_output_size=int(e["plain"]))
            if len(plain) != e["plain"] or _check(plain) != e["check"]:
                raise ValueError(f"frame {k} is damaged")
            out.append(plain)
        return b"".join(out)

    def rows(self, doc_ids: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, first id's place in the file, ids) of all or some documents."""
        which = range(len(self.documents)) if doc_ids is None else np.flatnonzero(
            np.isin(self.documents["doc_id"], list(doc_ids)) & (self.documents["set"] == 1))
        for row in which:
            r = self.documents[row]
            yield int(r["doc_id"]) if r["set"] else None, int(self.starts[row]), self.ids(int(row))


def write(docs: DataFrame, path: str | None = None, tokenizer: str | None = None,
          end_id: int = END_ID, level: int = LEVEL, frame_ids: int = FRAME_IDS,
          chunks: int = CACHE_CHUNKS) -> DataFrame:
    """Write the token files under ``path`` (default: a new shared folder) and
    return one row per file: part, file, documents, ids and ``base``, the
    number of ids in all files before it.  ``chunks`` is how
    many distinct chunks of text a worker remembers."""
    path = path or shared_path(docs.sparkSession, "tokens")
    vocabulary = tokenizer or tokenizer_path()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        sink = writer = None
        total = 0
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                if writer is None:
                    store, folder = fs.FileSystem.from_uri(path)
                    store.create_dir(folder, recursive=True)
                    name = f"part-{part:06d}.tokens"
                    draft = f"{folder}/_{name}.{uuid.uuid4().hex}"
                    sink = store.open_output_stream(draft)
                    writer = TokenFileWriter(sink, level, frame_ids)
                flat, at = encoder(vocabulary, chunks).encode(piece.column("text").to_pylist())
                total += len(flat) + piece.num_rows
                for i, doc in enumerate(piece.column("doc_id").to_pylist()):
                    writer.add(doc, np.concatenate([flat[at[i]:at[i + 1]], end]))
        if writer is not None:
            writer.finish()
            sink.close()
            store.move(draft, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [f"{path.rstrip('/')}/{name}"],
                "documents": [len(writer.records)], "ids": [total]})

    key = F.xxhash64("text")
    ordered = take(docs, "doc_id", "text").repartitionByRange("doc_id", key) \
        .sortWithinPartitions("doc_id", key)
    files = written(ordered.mapInArrow(task, FILE_SCHEMA), "token-files")
    # One row per file: a running sum over them is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(spark: SparkSession, files: DataFrame, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """Documents of the files that ``write`` listed: doc_id, start (ids of all
    documents before it) and ids.  With ``doc_ids`` only those documents'
    frames are read."""
    wanted = None if doc_ids is None else list(doc_ids)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for file, base in zip(*(batch.column(c).to_pylist() for c in ("file", "base"))):
                store, name = fs.FileSystem.from_uri(file)
                with store.open_input_file(name) as source:
                    held, size = [], 0
                    for doc, start, ids in TokenFileReader(source).rows(wanted):
                        held.append((doc, base + start, ids))
                        size += len(ids)
                        if size > 1 << 22:
                            yield _documents(held)
                            held, size = [], 0
                    if held:
                        yield _documents(held)

    # A file is one small row here and a task's work there: each goes to a task of its own.
    place = (F.row_number().over(Window.orderBy("file")) - 1).alias("place")
    spread = files.select("file", "base", place).repartitionById(max(1, files.count()), "place")
    return spread.select("file", "base").mapInArrow(task, DOCUMENT_SCHEMA)


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, ids = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())],
        names=["doc_id", "start", "ids"])
