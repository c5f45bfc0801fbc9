"""What the operators of this subpackage share: shared-folder tables, bounded
Arrow slices, query registration."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import RecordBatch
from pyspark.sql import DataFrame, SparkSession

from crawlsieve.session import apply_defaults

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Word separators of every contract: space and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
SLICE_BYTES = 8 << 20


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder, as a URI, below the one the cluster names in
    `spark.checkpoint.dir`; where that is unset (tests), below one of our own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        from crawlsieve.session import shared_root
        root = shared_root(spark)
    if "://" not in root and not root.startswith("file:"):
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(root)
        root = path.getFileSystem(conf).makeQualified(path).toString()
    return f"{root.rstrip('/')}/crawlsieve-llm/{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """`df` written to the shared folder and read back: cuts the lineage
    with files that survive lost executors, and is computed once."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """A worker lives on from task to task: memory that its allocators hold free goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of glibc
    if trim is not None:
        trim(0)


def squeeze(counts: np.ndarray) -> bytes:
    """A mostly empty array of numbers as compressed bytes."""
    return zstandard.ZstdCompressor(level=1).compress(counts.tobytes())


def unsqueeze(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def columns(*arrays: np.ndarray) -> bytes:
    """Arrays of 4 and 8 bytes a value as compressed bytes, like bytes side by side."""
    return squeeze(np.concatenate([np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).ravel() for a in arrays]))


def uncolumns(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw, sizes = unsqueeze(data, "u1"), [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(raw) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


def slices(batches: Iterator[RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[RecordBatch]:
    """The batches, cut so that the values of one string or binary column stay
    near `most` bytes (a single larger value is passed on alone)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(at, to - at)
            at = to

