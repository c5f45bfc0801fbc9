"""Token-ID files of shuffled bit planes (operator 3).

Documents are range-partitioned and sorted by id; each task encodes its
documents and writes one file.  A file holds blocks of `block_ids` ids.  A
block is transposed into bit planes (plane p holds bit p of every id) or byte
planes, only as many as its largest id needs, and each plane is compressed with
zstandard.  The file ends with a chunk index (place and size of every plane),
a document index (id and number of ids) and the index's length, so that a
reader can fetch any chunk by itself.

Sizes: the range shuffle moves the texts once; a task holds one Arrow slice, one
block and its indexes.  The driver sees one row per file (its counts), from
which it derives the position of each file's first id.  A lost task writes the
same file again under a temporary name and moves it in place.

Defined cases: null and empty texts have only the end id; repeated ids stay
separate, ordered by text; a null id comes first; an empty table has no files
and no rows; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsieve.files import open_path, write_whole
from crawlsieve.llm.common import register, shared_folder, slices, table
from crawlsieve.llm.encode import encoder, tokenizer_file, with_end

# file format, version 1; integers are little-endian
MAGIC = b"CSPLANE1"
TAIL = struct.Struct("<QQ8s")     # bytes of the compressed index, its offset, MAGIC
BLOCK_IDS = 1 << 16
LEVEL = 3
END_ID = 2
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, unit: str = "bit") -> list[bytes]:
    """The planes of a block of ids, lowest first."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    if unit == "bit":
        return [np.packbits((ids >> np.uint32(p)) & np.uint32(1)).tobytes() for p in range(top)]
    if unit == "byte":
        return [(ids >> np.uint32(8 * p)).astype(np.uint8).tobytes() for p in range((top + 7) // 8)]
    raise ValueError(f"unit is 'bit' or 'byte', not {unit!r}")


def from_planes(planes: list[bytes], n: int, unit: str = "bit") -> np.ndarray:
    """The ids of a block, from its planes."""
    ids = np.zeros(n, np.uint32)
    for p, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        if unit == "bit":
            ids |= np.unpackbits(raw, count=n).astype(np.uint32) << np.uint32(p)
        else:
            ids |= raw.astype(np.uint32) << np.uint32(8 * p)
    return ids


class PlaneWriter:
    """Streams ids into one file."""

    def __init__(self, out, unit: str = "bit", block_ids: int = BLOCK_IDS, level: int = LEVEL):
        self.out, self.unit, self.block = out, unit, block_ids
        self.packer = zstandard.ZstdCompressor(level=level)
        self.held, self.n_held, self.at = [], 0, 0
        self.chunks: list[tuple[int, int, list[int]]] = []   # offset, ids, plane sizes
        self.doc_ids: list[np.ndarray] = []
        self.doc_null: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _block(self, ids: np.ndarray) -> None:
        offset, sizes = self.at, []
        for plane in to_planes(ids, self.unit):
            packed = self.packer.compress(plane)
            sizes.append(len(packed))
            self._put(packed)
        self.chunks.append((offset, len(ids), sizes))

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.doc_ids.append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        self.doc_null.append(doc_ids.is_null().to_numpy(zero_copy_only=False))
        self.sizes.append(sizes.astype(np.int64))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            whole = np.concatenate(self.held)
            full = len(whole) // self.block * self.block
            for i in range(0, full, self.block):
                self._block(whole[i:i + self.block])
            self.held, self.n_held = [whole[full:]], len(whole) - full

    def close(self) -> tuple[int, int]:
        """Writes the index; returns (documents, ids) of the file."""
        if self.n_held:
            self._block(np.concatenate(self.held))
        ids, null, sizes = (np.concatenate(x) if x else np.zeros(0, np.int64)
                            for x in (self.doc_ids, self.doc_null, self.sizes))
        index = struct.pack("<BQQ", self.unit == "bit", len(self.chunks), len(ids))
        for offset, n, planes in self.chunks:
            index += struct.pack(f"<QIB{len(planes)}I", offset, n, len(planes), *planes)
        index += ids.astype("<i8").tobytes() + np.packbits(null.astype(bool)).tobytes() + sizes.astype("<i8").tobytes()
        packed = self.packer.compress(index)
        start = self.at
        self._put(packed)
        self._put(TAIL.pack(len(packed), start, MAGIC))
        return len(ids), int(sizes.sum())


class PlaneReader:
    """Reads the index of one file, then any of its chunks."""

    def __init__(self, source, size: int):
        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        length, start, magic = TAIL.unpack(self._get(size - TAIL.size, TAIL.size))
        if magic != MAGIC or self._get(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of token planes")
        index = self.unpacker.decompress(self._get(start, length))
        bit, n_chunks, n_docs = struct.unpack_from("<BQQ", index)
        self.unit, at = "bit" if bit else "byte", struct.calcsize("<BQQ")
        self.chunks = []
        for _ in range(n_chunks):
            offset, n, planes = struct.unpack_from("<QIB", index, at)
            at += struct.calcsize("<QIB")
            self.chunks.append((offset, n, struct.unpack_from(f"<{planes}I", index, at)))
            at += 4 * planes
        self.doc_ids = np.frombuffer(index, "<i8", n_docs, at)
        at += 8 * n_docs
        bits = (n_docs + 7) // 8
        self.doc_null = np.unpackbits(np.frombuffer(index, np.uint8, bits, at), count=n_docs).astype(bool)
        self.sizes = np.frombuffer(index, "<i8", n_docs, at + bits)

    def _get(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def chunk(self, k: int) -> np.ndarray:
        offset, n, sizes = self.chunks[k]
        data, planes, at = self._get(offset, sum(sizes)), [], 0
        for size in sizes:
            planes.append(self.unpacker.decompress(data[at:at + size]))
            at += size
        return from_planes(planes, n, self.unit)

    def checksums(self) -> Iterator[int]:
        """Unsigned crc32 of each document's ids, chunk after chunk."""
        k, held, at = 0, b"", 0
        for size in self.sizes:
            crc, need = 0, 4 * int(size)
            while need:
                if at == len(held):
                    held, at, k = self.chunk(k).astype("<u4").tobytes(), 0, k + 1
                part = held[at:at + need]
                crc, at, need = zlib.crc32(part, crc), at + len(part), need - len(part)
            yield crc


def write_ids(docs: DataFrame, folder: str, file: str, key: str = "doc_id", text: str = "text",
              end_id: int = END_ID, unit: str = "bit", block_ids: int = BLOCK_IDS) -> list:
    """Writes the files; returns one row (path, docs, ids) per file, in order."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .repartitionByRange(parts, F.asc_nulls_first("doc_id"))
            .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, cut = TaskContext.get().partitionId(), slices(batches, 1)
        first = next(cut, None)
        if first is None:
            return
        counts = []

        def fill(out):
            writer, enc, batch = PlaneWriter(out, unit, block_ids), encoder(file), first
            while batch is not None:
                t = with_end(enc.encode(batch.column(1)), end_id)
                writer.add(batch.column(0), t.ids, np.diff(t.bounds))
                batch = next(cut, None)       # the same cut: `first` may be one slice of many of its batch
            counts.append(writer.close())

        uri = f"{folder}/ids-{part:06d}.planes"
        write_whole(uri, fill)
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [uri], "docs": [counts[0][0]], "ids": [counts[0][1]]})

    made = rows.mapInArrow(write, "part long, path string, docs long, ids long").collect()
    return sorted(made)


def read_ids(spark: SparkSession, files: list, rows_per_batch: int = 10_000) -> DataFrame:
    """doc_id, start, n_tokens and checksum of every document, from the files."""
    plan, start = [], 0
    for f in files:
        plan.append((f["path"], start))
        start += f["ids"]
    listed = spark.createDataFrame(plan, "path string, start long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, inside = open_path(path)
                with system.open_input_file(inside) as source:
                    reader = PlaneReader(source, source.size())
                    crcs = reader.checksums()
                    starts = start + np.cumsum(reader.sizes) - reader.sizes
                    for a in range(0, len(reader.sizes), rows_per_batch):
                        b = min(a + rows_per_batch, len(reader.sizes))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(reader.doc_ids[a:b], mask=reader.doc_null[a:b]), pa.array(starts[a:b]),
                             pa.array(reader.sizes[a:b]), pa.array([next(crcs) for _ in range(a, b)], pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.repartition(max(1, len(plan))).mapInArrow(read, ROWS)


@register("op3_token_planes")
def op3_token_planes(spark, sf_dir):
    """Every text of `documents` as ids, written to plane files and read back."""
    files = write_ids(table(spark, sf_dir, "documents"), shared_folder(spark), tokenizer_file())
    return read_ids(spark, files)
