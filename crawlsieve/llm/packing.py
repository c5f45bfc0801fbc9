"""Best-fit packing of token sequences (operator 9).

Documents become pieces of at most `capacity` tokens.  How pieces combine
depends only on how many pieces there are of each length, so the plan is made on
the histogram of lengths: at most `capacity` counts, whatever the size of the
corpus.  Pieces above a third of the capacity (at most two per sequence) are
matched greedily, largest first, each with the largest one that fits; the
smaller pieces then fill the smallest gap that holds them, in bulk.

The plan is a list of runs: the pieces of one length with ranks `from ..
from + n - 1` go to as many consecutive sequences at one offset.  Every piece gets
its rank among those of its length from counts per input partition (a prefix sum
over partitions) and looks its run up by (length, rank / `SPAN`), a key that at
most `SPAN` pieces share, so no length is hot.

Only the pieces' numbers are written and shuffled, never ids or texts.

Defined cases: null and empty texts are one piece, the end id; repeated rows
are separate documents; an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlsieve.llm.common import register, slices, stored, table
from crawlsieve.llm.encode import encoder, tokenizer_file, with_end

CAPACITY = 2048
END_ID = 0
SPAN = 4096
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")


def pieces(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID,
           capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its length, checksum and its rank among the pieces
    of its length in its partition."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc, seen = TaskContext.get().partitionId(), encoder(file), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, 1):
            t = with_end(enc.encode(batch.column(1)), end_id)
            sizes = np.diff(t.bounds)
            n = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, sizes[doc] - start)
            raw, first = memoryview(t.ids.astype("<u4").tobytes()), 4 * (t.bounds[doc] + start)
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(first.tolist(), (first + 4 * length).tolist())]
            order = np.argsort(length, kind="stable")
            run = length[order]
            rank = np.empty(len(run), np.int64)
            rank[order] = seen[run] + np.arange(len(run)) - np.searchsorted(run, run)
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                 pa.array(crc, pa.int64()), pa.array(np.full(len(doc), part), pa.int32()), pa.array(rank)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return rows.mapInArrow(cut, PIECES)


class Plan:
    """Packs a histogram of lengths into sequences, in bulk."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.left, self.used = capacity, dict(counts), dict.fromkeys(counts, 0)
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []   # length, from rank, pieces, sequence, offset
        self.gaps: list[int] = []                              # open gaps, ascending
        self.open: dict[int, list[tuple[int, int]]] = {}       # gap -> (first sequence, how many)
        self._large(sorted((c for c in counts if 3 * c > capacity and counts[c]), reverse=True))
        for length in sorted((c for c in counts if 3 * c <= capacity), reverse=True):
            self._small(length)

    def _place(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.runs.append((length, self.used[length], n, sequence, offset))
        self.used[length] += n
        self.left[length] -= n

    def _free(self, gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if gap not in self.open:
                insort(self.gaps, gap)
                self.open[gap] = []
            self.open[gap].append((sequence, n))

    def _large(self, lengths: list[int]) -> None:
        ascending = lengths[::-1]
        while ascending:
            a = ascending[-1]
            if not self.left[a]:
                ascending.pop()
                continue
            k = bisect_left(ascending, self.capacity - a + 1) - 1   # the largest that fits beside a
            while k >= 0 and self.left[ascending[k]] < (2 if ascending[k] == a else 1):
                if not self.left[ascending[k]]:
                    del ascending[k]
                k -= 1
            if k < 0:
                n = self.left[a]
                self._place(a, n, self.sequences, 0)
                self._free(self.capacity - a, self.sequences, n)
            else:
                b = ascending[k]
                n = self.left[a] // 2 if b == a else min(self.left[a], self.left[b])
                self._place(a, n, self.sequences, 0)
                self._place(b, n, self.sequences, a)
                self._free(self.capacity - a - b, self.sequences, n)
            self.sequences += n

    def _small(self, length: int) -> None:
        while self.left[length]:
            at = bisect_left(self.gaps, length)
            if at == len(self.gaps):  # no gap holds it: open what the rest needs
                n = -(-self.left[length] // (self.capacity // length))
                self._place(length, n, self.sequences, 0)
                self._free(self.capacity - length, self.sequences, n)
                self.sequences += n
                continue
            gap = self.gaps[at]
            first, many = self.open[gap].pop()
            if not self.open[gap]:
                del self.open[gap], self.gaps[at]
            n = min(many, self.left[length])
            self._place(length, n, first, self.capacity - gap)
            self._free(gap - length, first, n)
            self._free(gap, first + n, many - n)


def pack(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID,
         capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    spark = docs.sparkSession
    rows = stored(pieces(docs, file, key, text, end_id, capacity), "pieces")
    counts = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # at most `capacity` rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = Plan(histogram, capacity).runs
    runs = (spark.createDataFrame([tuple(map(int, r)) for r in runs],
                                  "length long, first long, n long, sequence long, offset long")
            .withColumn("span", F.explode(F.sequence(F.expr(f"first div {SPAN}"), F.expr(f"(first + n - 1) div {SPAN}")))))
    ranked = (rows.join(base, ["length", "part"])
              .withColumn("rank", F.col("rank") + F.col("base"))
              .withColumn("span", F.expr(f"rank div {SPAN}")))
    found = ranked.join(runs, ["length", "span"]).where("rank >= first and rank < first + n")
    return found.select(F.col("doc_id").alias(key), "piece", "start", "length", "ids_crc32",
                        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")


@register("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf_dir):
    """All `documents` packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_file())
