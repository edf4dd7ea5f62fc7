"""Token files: independent zstandard frames, a document index, and a trailing seek table with checksums.

A file is a series of zstandard frames, each with little-endian ids (16 bits wide if the vocabulary allows it) of one
document or a part of a long one; then a skippable frame with the document index; then the seek table of the public
zstandard seekable format (a skippable frame with each frame's sizes and the low 32 bits of its content's XXH64).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, open_uri, released, table
from .encoders import part_encoder, vocabulary

END = 0
FRAME_IDS = 1 << 17  # ids of a frame at most, so that a huge document needs little memory at a time
# Fixed values of the zstandard seekable format.
INDEX_MAGIC, TABLE_MAGIC, FOOT_MAGIC, HAS_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
DOC = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("n", "<i8"), ("frame", "<u4"), ("frames", "<u4")])
HEAD, FOOT = struct.Struct("<II"), struct.Struct("<IBI")


class Writer:
    def __init__(self, out, width: int, level: int = 1):
        self.out, self.width = out, width
        self.pack = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[tuple[bool, int, int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """ids: little-endian, as wide as the file's."""
        first, step = len(self.entries), FRAME_IDS * self.width
        for k in range(0, len(ids), step):
            raw = ids[k : k + step]
            frame = self.pack(raw)
            self.out.write(frame)
            self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.docs.append((doc_id is not None, doc_id or 0, len(ids) // self.width, first, len(self.entries) - first))

    def close(self) -> None:
        docs = bytes([self.width]) + np.array(self.docs, DOC).tobytes()
        self.out.write(HEAD.pack(INDEX_MAGIC, len(docs)) + docs)
        table_ = np.array(self.entries, ENTRY).tobytes()
        self.out.write(HEAD.pack(TABLE_MAGIC, len(table_) + FOOT.size) + table_ + FOOT.pack(len(self.entries), HAS_CHECKSUMS, FOOT_MAGIC))


class Reader:
    """Reads the tail of a file, and then only the frames that are asked for."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        n, flags, magic = FOOT.unpack(self._at(size - FOOT.size, FOOT.size))
        if (magic, flags) != (FOOT_MAGIC, HAS_CHECKSUMS):
            raise ValueError("no seek table with checksums at the end of the file")
        at = size - FOOT.size - n * ENTRY.itemsize
        self.entries = np.frombuffer(self._at(at, n * ENTRY.itemsize), ENTRY)
        self.starts = np.concatenate(([0], np.cumsum(self.entries["packed"], dtype=np.int64)))
        index = int(self.starts[-1])
        magic, length = HEAD.unpack(self._at(index, HEAD.size))
        if magic != INDEX_MAGIC:
            raise ValueError("no document index before the seek table")
        raw = self._at(index + HEAD.size, length)
        self.dtype, self.docs = f"<u{raw[0]}", np.frombuffer(raw[1:], DOC)
        self.unpack = zstandard.ZstdDecompressor().decompress

    def _at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        out = self.file.read(n)
        if len(out) != n:
            raise ValueError("the file ends too early")
        return out

    def frames(self, doc: np.void) -> Iterator[np.ndarray]:
        for k in range(int(doc["frame"]), int(doc["frame"]) + int(doc["frames"])):
            raw = self.unpack(self._at(int(self.starts[k]), int(self.entries["packed"][k])))
            if len(raw) != self.entries["plain"][k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.entries["check"][k]:
                raise ValueError(f"frame {k} is damaged")
            yield np.frombuffer(raw, self.dtype)

    def read(self, doc_ids: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """Only the frames of these documents are read and decompressed."""
        for doc in self.docs[np.isin(self.docs["doc_id"], list(doc_ids)) & (self.docs["has_id"] == 1)]:
            yield int(doc["doc_id"]), np.concatenate([*self.frames(doc), np.zeros(0, self.dtype)])


def write_token_files(docs: DataFrame, folder: str, scratch: Scratch, vocab: str | None = None, width: int = 2) -> DataFrame:
    """Writes token files below folder and returns the manifest: part, path, n_docs, n_tokens.

    Files hold documents in ascending order of doc_id (null first), and follow each other by part. Each task writes
    under a name of its own attempt and then renames: a task that runs again, after an executor is lost, leaves one
    whole file. Repeated ids are all written, in the order of their texts. `width` is that of an id in bytes.
    """
    path, run = vocab or vocabulary("byte_bpe_50k.json"), uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        uri, out, n, docs_ = f"{folder}/part-{task.partitionId():08d}.zst", None, 0, 0
        coder = part_encoder(path, False, run, width)
        end = END.to_bytes(width, "little")
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), coder.encode(t.as_py() for t in batch.column(1)), strict=True):
                if out is None:
                    store, at, file = open_uri(f"{uri}.{task.taskAttemptId()}.tmp", write=True)
                    out = Writer(file, width)
                out.add(name, raw + end)
                n, docs_ = n + len(raw) // width + 1, docs_ + 1
        if out is not None:
            out.close()
            file.close()
            store.move(at, at.removesuffix(f".{task.taskAttemptId()}.tmp"))
            yield pa.record_batch([pa.array([task.partitionId()], pa.int64()), pa.array([uri]), pa.array([docs_], pa.int64()), pa.array([n], pa.int64())], names=["part", "path", "n_docs", "n_tokens"])
        released()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return scratch.keep(ordered.mapInArrow(write, "part long, path string, n_docs long, n_tokens long"), "manifest")


def read_token_files(manifest: DataFrame, doc_ids: list[int] | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, or of the given ones, from the files alone."""
    first = F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))  # a row per file
    placed = manifest.select("path", F.coalesce(first, F.lit(0)).alias("first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_uri(uri)[2] as file:
                    reader = Reader(file)
                    starts = base + np.cumsum(reader.docs["n"]) - reader.docs["n"]
                    rows: list[tuple] = []
                    for doc, start in zip(reader.docs, starts.tolist(), strict=True):
                        if doc_ids is not None and not (doc["has_id"] and int(doc["doc_id"]) in wanted):
                            continue
                        crc, parts = 0, []
                        for ids in reader.frames(doc):
                            wide = ids.astype("<u4").tobytes()
                            crc = zlib.crc32(wide, crc)
                            if with_ids:
                                parts.append(wide)
                        rows.append((int(doc["doc_id"]) if doc["has_id"] else None, start, int(doc["n"]), crc, b"".join(parts)))
                        if len(rows) == 4096 or sum(map(len, parts)) > 1 << 24:
                            yield out(rows)
                            rows = []
                    if rows:
                        yield out(rows)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.binary()], strict=True)]
        return pa.record_batch(cols[: 4 + with_ids], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids])

    wanted = set(doc_ids or ())
    tasks = max(1, manifest.count())
    return placed.repartition(tasks).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def op4_zstd_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), scratch.path("files"), scratch)
    return read_token_files(manifest)
