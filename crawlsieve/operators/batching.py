"""Batching (B1-B5).

B1 numbers rows across blocks without any global sort: per-block counts
are prefix-summed in two bounded levels (blocks within a super-block,
super-blocks within a crawl) and joined back to the rows.  The only
window over data rows is inside one index block, which the index format
bounds (a block is one compressed range of the index file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsieve.session import written

SUPER_BLOCK = 1024  # blocks per prefix-sum group; bounds every window


def _block_offsets(counts: DataFrame, group: list[str], block: str, n: str) -> DataFrame:
    """Exclusive running sum of ``n`` over ``block`` within ``group``.

    counts: one row per (group, block).  Two bounded windows instead of
    one window over all blocks of a crawl.
    """
    sb = F.floor(F.col(block) / SUPER_BLOCK)
    c = counts.withColumn("_sb", sb)
    supers = c.groupBy(*group, "_sb").agg(F.sum(n).alias("_sn"))
    w_super = Window.partitionBy(*group).orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    supers = supers.withColumn("_soff", F.coalesce(F.sum("_sn").over(w_super), F.lit(0)))
    w_in = Window.partitionBy(*group, "_sb").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    inner = c.withColumn("_ioff", F.coalesce(F.sum(n).over(w_in), F.lit(0)))
    return (inner.join(supers.select(*group, "_sb", "_soff"), [*group, "_sb"])
                 .select(*group, block, (F.col("_soff") + F.col("_ioff")).cast("bigint").alias("_off")))


def batch_fixed_size(df: DataFrame, batch_size: int = 50, group=("crawl",), block: str = "block_id",
                     order: str = "line_no", out: str = "batch_no") -> DataFrame:
    """B1: cut rows (in block, line order) every ``batch_size`` rows per group.

    The last partial batch is kept.  ``batch_no`` is 0-based.

    ``df`` is read by two branches (rows, and per-block counts), so pass a
    written table (as ``plans.jobs.run_batcher`` does): the count branch is
    then a scan of three columns with a map-side partial count, and only one
    row per block and map task crosses its shuffle.
    """
    g = list(group)
    w_block = Window.partitionBy(*g, block).orderBy(order)
    rows = df.withColumn("_rn", F.row_number().over(w_block))
    counts = df.groupBy(*g, block).agg(F.count(F.lit(1)).alias("_n"))
    offs = _block_offsets(counts, g, block, "_n")
    return (rows.join(offs, [*g, block])
                .withColumn(out, F.floor((F.col("_off") + F.col("_rn") - 1) / batch_size).cast("bigint"))
                .drop("_rn", "_off"))


def batch_per_block(df: DataFrame, batch_size: int = 1000, group=("crawl",), block: str = "block_id",
                    order: str = "line_no", out: str = "batch_no") -> DataFrame:
    """B2: batches restart at every block; the block's remainder is flushed."""
    w = Window.partitionBy(*group, block).orderBy(order)
    return df.withColumn(out, F.floor((F.row_number().over(w) - 1) / batch_size).cast("bigint"))


def batch_messages(df: DataFrame, group=("crawl", "batch_no"), order=("block_id", "line_no")) -> DataFrame:
    """One JSON array message per batch, entries in file order.

    Each entry is serialised first (a struct holding a map cannot be
    sorted); groups are bounded by the batch size.
    """
    entry = F.to_json(F.struct("surt_url", "timestamp", "metadata"))
    items = F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order], entry.alias("_j"))))
    return (df.groupBy(*group)
              .agg(items.alias("_items"))
              .select(*group, F.size("_items").cast("bigint").alias("n"),
                      F.concat(F.lit("["), F.array_join(F.transform("_items", lambda x: x["_j"]), ","),
                               F.lit("]")).alias("body")))


def batch_stats(df: DataFrame, group=("crawl", "batch_no"), text: str | None = None) -> DataFrame:
    """Items per batch, and estimated bytes (chars * 1.5) when a text column is given."""
    aggs = [F.count(F.lit(1)).alias("n_items")]
    if text:
        aggs.append(F.sum(F.length(text) * F.lit(1.5)).alias("est_bytes"))
    return df.groupBy(*group).agg(*aggs)


def _fold_lane_batches(lane: str, length: str, max_docs: int, max_bytes: float, out: str, keep: list[str]):
    def fold(batches):
        import numpy as np
        import pyarrow as pa
        cur_lane = object()
        docs = 0
        size = 0.0
        batch = 0
        for b in batches:
            lanes = b.column(lane).to_numpy(zero_copy_only=False)
            lens = b.column(length).to_numpy(zero_copy_only=False)
            res = np.empty(b.num_rows, dtype=np.int64)
            for i in range(b.num_rows):
                if lanes[i] != cur_lane:
                    cur_lane = lanes[i]
                    docs, size, batch = 0, 0.0, 0
                res[i] = batch
                docs += 1
                size += float(lens[i]) * 1.5
                if docs >= max_docs or size >= max_bytes:
                    batch += 1
                    docs, size = 0, 0.0
            cols = [b.column(c) for c in keep] + [pa.array(res, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, out])
    return fold


def batch_threshold(df: DataFrame, lane: str | None = "lane", order=("doc_id",), text: str = "full_text",
                    max_docs: int = 10, max_bytes: float = 1024 * 1024, out: str = "upload_batch_no",
                    block_rows: int | None = None, **options) -> DataFrame:
    """Threshold upload batches per lane.

    A document is added, then the batch closes when it holds ``max_docs``
    documents or its estimated size (chars * 1.5) reaches ``max_bytes``;
    the closing document belongs to the closed batch.  Lanes are cut in
    parallel (``operators.threshold``), so one lane may hold all rows; only
    lanes, order keys and lengths are read for it, never texts.  The rows are
    written once with an id, to which the numbers are joined.  Rows of a lane
    with equal order keys go by length.

    ``lane=None`` uses the partition as the lane (adds a ``lane`` column): no
    shuffle, a sort inside each partition and a fold over lane and length.
    """
    if lane is not None:
        from crawlsieve.operators import threshold
        row = unused("_row", df.columns)
        rows = written(df.withColumn(row, F.monotonically_increasing_id()), "documents")
        numbers = threshold.batch_numbers(rows, lane, order, F.length(text), max_docs, max_bytes, row, block_rows, **options)
        return (rows.join(numbers.withColumnRenamed("id", row).withColumnRenamed("number", out), row)
                    .select(*df.columns, out))
    df = df.withColumn("lane", F.spark_partition_id())
    prepared = df.withColumn("_len", F.length(text)).sortWithinPartitions(*order)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.LongType())])
    return prepared.mapInArrow(
        _fold_lane_batches("lane", "_len", max_docs, float(max_bytes), out, list(df.columns)), schema)


def unused(name: str, columns: list[str]) -> str:
    """`name`, or the first longer one that no column has."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def lane_of(key, lanes: int) -> "F.Column":
    """Default lane: hash of the key into ``lanes`` buckets."""
    return F.pmod(F.xxhash64(key), F.lit(lanes)).cast("int")
