"""Threshold batches of long lanes, in parallel.

A document is added to the open batch of its lane, then the batch closes when it holds
``max_docs`` documents or ``max_bytes`` estimated bytes.  Where a batch ends depends on
where it began, so a lane looks sequential; it is not, because what a stretch of a lane
does to an open batch is a function that can be composed:

1. Rows (lane, order, length; no text) are range-partitioned and sorted; per-lane
   positions come from one running sum over partitions.  A lane is cut into blocks of
   consecutive rows, at least ``max_docs`` each, so no batch spans a whole block.
2. Per block, a binary search in the prefix sums of lengths gives the end of the batch
   that begins at each row, and pointer doubling gives the batch still open at the end of
   the block.  Those are the few states with which the next block can be entered.
3. Per block, the function from the states at its start to those at its end, with the
   number of batches closed.  Functions of ``FAN`` blocks are composed at a time, up
   to one per lane; walking back down gives every block the state and number it begins with.
4. Per block, the cuts from there; the numbers are joined to the documents by row id.

A lane with a third of all rows is many blocks, hence many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlsieve.session import written
from crawlsieve.sources.ranged import work_partitions

BLOCK_ROWS = 1 << 14
MOST_DOCS = 1 << 22     # a block holds a batch's worth of (length, id) pairs
FAN = 64
BLOCK = "lane_id bigint, block bigint, n bigint, lengths binary, ids binary, docs binary, sizes binary"
STEP = "lane_id bigint, block bigint, exits binary, closed binary"
ENTRY = "lane_id bigint, block bigint, entry bigint, closed bigint"


def _long(x: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(x, "<i8").tobytes()], pa.binary())


def _longs(value: bytes) -> np.ndarray:
    return np.frombuffer(value, "<i8")


class Cuts:
    """Where batches end in one block, for any begin."""

    def __init__(self, lengths: np.ndarray, max_docs: int, need: int):
        self.n, self.max_docs, self.need = len(lengths), max(max_docs, 1), need
        self.sums = np.concatenate([[0], np.cumsum(lengths)])

    def end(self, begin, docs=0, size=0) -> np.ndarray:
        """One past the last row of the batch that has `docs` and `size` before row
        `begin`; beyond n where it stays open."""
        begin = np.asarray(begin)
        full = np.searchsorted(self.sums, self.sums[begin] - size + self.need, side="left")
        return np.minimum(np.maximum(full, begin + 1), np.maximum(begin + self.max_docs - docs, begin + 1))

    def open_at_end(self) -> tuple[np.ndarray, np.ndarray]:
        """For a batch that begins at each row 0..n: the begin of the batch that is open at
        the end of the block, and how many close before it."""
        rows = np.arange(self.n + 1)
        after = self.end(rows)
        stays = after > self.n
        to, closed = np.where(stays, rows, after), (~stays).astype(np.int64)
        while True:
            further = to[to]
            if (further == to).all():
                return to, closed
            closed, to = closed + closed[to], further

    def states(self, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, length) of open batches that began at these rows."""
        return self.n - begins, self.sums[self.n] - self.sums[begins]


def _to_blocks(max_docs: int, need: int):
    """Rows sorted by (lane_id, block, at) -> one row per block, with the states it can end in."""
    def row(key, lengths, ids) -> pa.RecordBatch:
        lengths, ids = np.concatenate(lengths), np.concatenate(ids)
        cuts = Cuts(lengths, max_docs, need)
        docs, sizes = cuts.states(np.unique(cuts.open_at_end()[0]))
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in (*key, len(ids))), *map(_long, (lengths, ids, docs, sizes))],
                                          names=["lane_id", "block", "n", "lengths", "ids", "docs", "sizes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lengths, ids = None, [], []
        for batch in batches:
            lane, block, length, row_id = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            starts = [0, *(np.flatnonzero((np.diff(lane) != 0) | (np.diff(block) != 0)) + 1), len(lane)]
            for lo, hi in zip(starts, starts[1:]):
                if lo == hi:
                    continue
                if key != (lane[lo], block[lo]):
                    if key is not None:
                        yield row(key, lengths, ids)
                    key, lengths, ids = (lane[lo], block[lo]), [], []
                lengths.append(length[lo:hi])
                ids.append(row_id[lo:hi])
        if key is not None:
            yield row(key, lengths, ids)
    return run


def _steps(max_docs: int, need: int):
    """Blocks with the states they can begin in -> the state each ends in, and batches closed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lane, block, lengths, docs, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                cuts = Cuts(_longs(lengths), max_docs, need)
                to, closed = cuts.open_at_end()
                ends = np.unique(to)
                first = cuts.end(0, _longs(docs), _longs(sizes))
                open_ = first > cuts.n      # only in the last block of a lane, which nothing follows
                at = np.where(open_, 0, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lane], pa.int64()), pa.array([block], pa.int64()), _long(np.searchsorted(ends, to[at])),
                     _long(np.where(open_, 0, 1 + closed[at]))], names=["lane_id", "block", "exits", "closed"])
    return run


def _rows_of(table: pa.Table) -> list[dict]:
    return table.sort_by("block").to_pylist()


def _compose(fan: int):
    """Consecutive blocks -> their function, as one block of the next level."""
    def run(table: pa.Table) -> pa.Table:
        rows = _rows_of(table)
        to, closed = _longs(rows[0]["exits"]), _longs(rows[0]["closed"])
        for r in rows[1:]:
            closed, to = closed + _longs(r["closed"])[to], _longs(r["exits"])[to]
        return pa.table({"lane_id": [rows[0]["lane_id"]], "block": pa.array([rows[0]["block"] // fan], pa.int64()),
                         "exits": _long(to), "closed": _long(closed)})
    return run


def _descend(entries: pa.Table, steps: pa.Table) -> pa.Table:
    """What each block of a group begins with, from what the group begins with."""
    out = []
    for e in entries.to_pylist():
        state, closed = e["entry"], e["closed"]
        for r in _rows_of(steps):
            out.append((r["lane_id"], r["block"], state, closed))
            state, closed = int(_longs(r["exits"])[state]), closed + int(_longs(r["closed"])[state])
    columns = list(zip(*out)) or [[]] * 4
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("lane_id", "block", "entry", "closed"), columns)})


def _numbers(max_docs: int, need: int):
    """Blocks with the states they can begin in, the one they do begin in and its batch
    number -> (row id, batch number)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lengths, ids, docs, sizes, entry, number in zip(*(c.to_pylist() for c in batch.columns)):
                cuts = Cuts(_longs(lengths), max_docs, need)
                ends, at = [], int(cuts.end(0, _longs(docs)[entry], _longs(sizes)[entry]))
                while at < cuts.n:
                    ends.append(at)
                    at = int(cuts.end(at))
                steps = np.zeros(cuts.n, np.int64)
                steps[ends] = 1
                yield pa.RecordBatch.from_arrays([pa.array(_longs(ids)), pa.array(number + np.cumsum(steps))], names=["id", "number"])
    return run


def _entries(steps: DataFrame, fan: int) -> DataFrame:
    """(lane_id, block, entry, closed): the state and the batch number each block begins with."""
    def grouped(level: DataFrame):
        return level.groupBy("lane_id", F.floor(F.col("block") / fan).alias("_g"))

    levels = [steps]
    while levels[-1].agg(F.max("block")).first()[0]:
        levels.append(written(grouped(levels[-1]).applyInArrow(_compose(fan), STEP), "composed"))
    zero = F.lit(0).cast("bigint")
    entries = levels.pop().select("lane_id", "block", zero.alias("entry"), zero.alias("closed"))
    for level in reversed(levels):
        at = entries.groupBy("lane_id", F.col("block").alias("_g"))
        entries = written(at.cogroup(grouped(level)).applyInArrow(_descend, ENTRY), "entries")
    return entries


def _positions(narrow: DataFrame, block_rows: int) -> DataFrame:
    """(lane_id, block, at, length, id): every row's place in its lane."""
    spark = narrow.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [c for c in narrow.columns if c not in ("_id",)]
    placed = written(narrow.repartitionByRange(parts, *keys, "_id").sortWithinPartitions(*keys, "_id")
                     .select("_lane", F.col("_length").alias("length"), F.col("_id").alias("id"),
                             F.monotonically_increasing_id().alias("place")), "sorted")
    part = F.shiftright("place", 33)
    pieces = placed.groupBy("_lane", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("_lane").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    pieces = pieces.select("_lane", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                           F.min("first").over(Window.partitionBy("_lane")).alias("lane_id"))
    at = F.col("place") - F.col("first") + F.col("before")
    return (placed.withColumnRenamed("_lane", "_l")
            .join(pieces, [F.col("_l").eqNullSafe(F.col("_lane")), F.shiftright("place", 33) == F.col("part")])
            .select("lane_id", F.floor(at / block_rows).alias("block"), at.alias("at"), "length", "id"))


def batch_numbers(rows: DataFrame, lane: str, order, length, max_docs: int, max_bytes: float,
                  row_id: str, block_rows: int | None = None, fan: int = FAN) -> DataFrame:
    """(id, number) for rows with a unique ``row_id``; ``length`` is a column of characters.

    Rows of a lane with equal order keys go by length, then row id."""
    if max_docs > MOST_DOCS:
        raise ValueError(f"max_docs is at most {MOST_DOCS}")
    need = -(-Fraction(max_bytes) * 2 // 3)             # least length whose 1.5-fold reaches max_bytes
    need = max(int(need), 0)
    if block_rows is None:
        block_rows = max(BLOCK_ROWS, 4 * max_docs)
    block_rows = max(block_rows, max_docs)
    narrow = rows.select(F.col(lane).alias("_lane"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                         F.coalesce(length.cast("bigint"), F.lit(0)).alias("_length"), F.col(row_id).alias("_id"))
    spread = _positions(narrow, block_rows)
    # a given number of tasks: what a block costs is not its bytes
    blocks = written(spread.repartition(work_partitions(rows.sparkSession), "lane_id", "block").sortWithinPartitions("lane_id", "block", "at")
                     .select("lane_id", "block", "length", "id").mapInArrow(_to_blocks(max_docs, need), BLOCK), "blocks")
    ends = blocks.select("lane_id", (F.col("block") + 1).alias("block"), "docs", "sizes")
    nothing = F.unhex(F.lit("00" * 8))
    states = (blocks.select("lane_id", "block", "lengths").join(ends, ["lane_id", "block"], "left")
              .select("lane_id", "block", "lengths", F.coalesce("docs", nothing).alias("docs"), F.coalesce("sizes", nothing).alias("sizes")))
    entries = _entries(written(states.mapInArrow(_steps(max_docs, need), STEP), "steps"), fan)

    begun = (entries.join(ends, ["lane_id", "block"], "left")
             .select("lane_id", "block", "closed", F.coalesce("docs", nothing).alias("docs"), F.coalesce("sizes", nothing).alias("sizes"), "entry"))
    return (blocks.select("lane_id", "block", "lengths", "ids").join(begun, ["lane_id", "block"])
            .select("lengths", "ids", "docs", "sizes", "entry", "closed").mapInArrow(_numbers(max_docs, need), "id bigint, number bigint"))
