"""Document fingerprints: one-permutation MinHash (operator 7).

Every 5-word shingle is hashed once; the upper bits choose one of `BINS` bins, which
keeps its least value.  Empty bins take the value of a full bin that the bin's own
probe sequence meets first (optimal densification: the probes depend on the bin
alone, so equal sets agree).  The low `BITS` bits of each bin are packed; two
fingerprints that agree in a share r of their bins are alike by
(r - c) / (1 - c) with c = 2^-BITS, the share that agrees by chance, cut to 0..1.

The query compares each document with its successor by descending id: rows are
range-partitioned and sorted once, a task streams its pairs, and only the first
and last row of each partition are joined across partitions.

Defined cases: a null text is empty; texts with fewer than five words are one
shingle; an empty fingerprint (no words) is like another empty one by 1, like
any other by 0; repeated ids are ordered by text; a null id comes last; a single
document follows itself; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsieve.llm.common import register, slices, stored, table
from crawlsieve.llm.words import mix64, shingle_hashes, split_words

BINS = 512
BITS = 4
SHINGLE = 5
PROBES = 16
SLICE = 2 << 20
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _probes(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and odd step of each bin's probe sequence over all bins."""
    h = mix64(np.arange(1, bins + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (h >> np.uint64(32)).astype(np.int64) % bins, (h.astype(np.int64) & (bins - 1)) | 1


def signatures(texts: pa.Array, k: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(texts x bins) low bits, and which texts have any shingle.  `bins` is a power of two."""
    n, shift = len(texts), bins.bit_length() - 1
    h, doc = shingle_hashes(split_words(texts), k)
    least = np.full(n * bins, _NONE)
    np.minimum.at(least, doc * bins + (h >> np.uint64(64 - shift)).astype(np.int64), h << np.uint64(shift))
    least = least.reshape(n, bins)
    full = least != _NONE
    some = full.any(axis=1)
    start, step = _probes(bins)
    row, empty = np.nonzero(~full & some[:, None])
    for at in range(0, bins, PROBES):
        if not len(row):
            break
        met = (start[empty, None] + step[empty, None] * np.arange(at, at + PROBES)) % bins
        hit = full[row[:, None], met]
        found = hit.any(axis=1)
        least[row[found], empty[found]] = least[row[found], met[found, hit[found].argmax(axis=1)]]
        row, empty = row[~found], empty[~found]
    return (mix64(least) & np.uint64((1 << bits) - 1)).astype(np.uint8), some


def pack(low: np.ndarray, some: np.ndarray, bits: int = BITS) -> list[str]:
    """Hexadecimal strings of the packed low bits; empty for no shingle."""
    planes = np.unpackbits(low[:, :, None], axis=2)[:, :, 8 - bits:]
    packed = np.packbits(planes.reshape(len(low), -1), axis=1)
    return [row.tobytes().hex() if s else "" for row, s in zip(packed, some)]


def likeness(a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity per row, corrected for chance agreement."""
    chance = 2.0 ** -bits
    alike = np.clip(((a == b).mean(axis=1) - chance) / (1.0 - chance), 0.0, 1.0)
    return np.where(some_a & some_b, alike, (~some_a & ~some_b).astype(float))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the next text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


ROW = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
                 ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                 ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string())])
ROW_DDL = ("kind int, part long, doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double, text string")
DONE, FIRST, LAST = 0, 1, 2
RESULT = ROW.names[2:9]


def _compare(doc_ids: pa.Array, texts: list[str], following: list[str], chained: bool) -> pa.RecordBatch:
    """Finished rows; `chained`: each text's successor is the next text, the last one's following[-1]."""
    n = len(texts)
    own = pa.array([*texts, following[-1]] if chained else [*texts, *following], pa.large_string())
    low, some = signatures(own)
    after = slice(1, n + 1) if chained else slice(n, 2 * n)
    changed = [edited(t, f) for t, f in zip(texts, following)]
    low_e, some_e = signatures(pa.array(changed, pa.large_string()))
    nothing = pa.nulls(n, pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, DONE, np.int32)), pa.array(np.zeros(n, np.int64)), doc_ids,
         pa.array([len(t) for t in texts], pa.int64()),
         pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]), pa.array(pack(low[:n], some[:n])),
         pa.array(pack(low_e, some_e)), pa.array(likeness(low[:n], low_e, some[:n], some_e)),
         pa.array(likeness(low[:n], low[after], some[:n], some[after])), nothing], schema=ROW)


def _end(kind: int, part: int, doc_id, text: str) -> pa.RecordBatch:
    row = {name: [None] for name in ROW.names} | {"kind": [kind], "part": [part], "doc_id": [doc_id], "text": [text]}
    return pa.RecordBatch.from_pydict(row, schema=ROW)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours in a sorted partition; its ends are passed on."""
    part, held = TaskContext.get().partitionId(), None
    for batch in slices(batches, 1, SLICE):
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        if held is None:
            yield _end(FIRST, part, ids[0].as_py(), texts[0])
        else:
            ids, texts = pa.concat_arrays([held[0], ids]), [held[1], *texts]
        if len(texts) > 1:
            yield _compare(ids.slice(0, len(texts) - 1), texts[:-1], texts[1:], chained=True)
        held = ids.slice(len(texts) - 1), texts[-1]
    if held is not None:
        yield _end(LAST, part, held[0][0].as_py(), held[1])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1, SLICE):
        yield _compare(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), chained=False)


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.desc_nulls_last("doc_id")
    rows = (docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
            .repartitionByRange(parts, order).sortWithinPartitions(order, "text"))
    out = stored(rows.mapInArrow(_stream, ROW_DDL), "neighbours")
    # one number per partition
    full = [r["part"] for r in out.where(f"kind = {FIRST}").select("part").orderBy("part").collect()]
    turn = spark.createDataFrame(list(zip(full, full[1:] + full[:1])), "part long, next_part long")
    first = out.where(f"kind = {FIRST}").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    ends = (out.where(f"kind = {LAST}").select("part", "doc_id", "text").join(turn, "part").join(first, "next_part")
            .select("doc_id", "text", "following").mapInArrow(_close, ROW_DDL))
    return out.where(f"kind = {DONE}").unionByName(ends).select(F.col("doc_id").alias(key), *RESULT[1:])


@register("op7_minhash_fingerprints")
def op7_minhash_fingerprints(spark, sf_dir):
    """Fingerprints of all `documents`, of their edited texts, and likeness."""
    return compare_neighbours(table(spark, sf_dir, "documents"))
