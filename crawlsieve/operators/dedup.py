"""URL deduplication.

D1 and D4 find the winners on narrow rows: the position of a line (crawl rank, block,
line) is one fixed-width number, so per URL key it is a hash aggregate with a map-side
partial step, and a hot key is one row per input partition before the shuffle.  The
payload comes late: one join of the winning positions back to the rows.  That join is
on the position, which is unique, so a hot URL is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlsieve.functions.cdx import normalize_surt
from crawlsieve.operators.batching import unused

ORDER_FIRST_SEEN = ("crawl_rank", "block_id", "line_no")


def with_dedup_key(df: DataFrame, surt: str = "surt_url", key: str = "url_key") -> DataFrame:
    return df.withColumn(key, normalize_surt(surt))


def position(rank="crawl_rank", block="block_id", line="line_no") -> Column:
    """Order of (crawl rank, block, line) as one number of fixed width; values outside
    its fields (8 digits, any long, 10 digits) raise."""
    r, b, n = (F.col(c).cast("decimal(38,0)") for c in (rank, block, line))
    packed = r * F.lit(str(10 ** 30)).cast("decimal(31,0)")
    packed = packed + (b + F.lit(str(2 ** 63)).cast("decimal(20,0)")) * F.lit(10 ** 10).cast("decimal(11,0)") + n
    fits = F.col(rank).between(0, 10 ** 8 - 1) & F.col(line).between(0, 10 ** 10 - 1) & F.col(block).isNotNull()
    return F.when(fits, packed).otherwise(F.raise_error(F.concat_ws(" ", F.lit("position out of range:"), rank, block, line))).cast("decimal(38,0)")


def _rows_at(df: DataFrame, place: str, winners: DataFrame) -> DataFrame:
    """Rows of ``df`` at the winning places, one of each (an index can name a block twice)."""
    first = F.row_number().over(Window.partitionBy(place).orderBy(F.lit(1)))
    rn = unused("_rn", df.columns)
    return df.join(winners, place, "left_semi").withColumn(rn, first).where(F.col(rn) == 1).drop(rn, place)


def dedup_first_seen(df: DataFrame, surt: str = "surt_url", order=ORDER_FIRST_SEEN,
                     key: str = "url_key") -> DataFrame:
    """Per URL key keep the row that comes first in (crawl_rank, block, line).

    Deterministic replacement for the shared seen-set: the winner is the
    minimum of the explicit order key, independent of partitioning.
    """
    place = unused("_place", df.columns)
    placed = df.withColumn(place, position(*order))
    winners = placed.groupBy(normalize_surt(surt).alias(key)).agg(F.min(place).alias(place)).select(place)
    return _rows_at(placed, place, winners)


def dedup_latest(df: DataFrame, surt: str = "surt_url", ts: str = "timestamp",
                 key: str = "url_key", order=ORDER_FIRST_SEEN) -> DataFrame:
    """Per URL key keep the most recent capture (timestamp, then crawl
    rank, then position in the index, all descending: fully deterministic).  A
    timestamp that is not a number is older than any other."""
    place = unused("_place", df.columns)
    placed = df.withColumn(place, position(*order))
    time = F.coalesce(F.col(ts).try_cast("bigint"), F.lit(-1))
    narrow = placed.select(normalize_surt(surt).alias("_k"), time.alias("_t"), place)
    latest = narrow.groupBy(F.col("_k").alias("_key")).agg(F.max("_t").alias("_time"))
    at_latest = narrow.join(latest, [F.col("_k").eqNullSafe(F.col("_key")), F.col("_t") == F.col("_time")], "left_semi")
    winners = at_latest.groupBy("_k").agg(F.max(place).alias(place)).select(place)
    return _rows_at(placed, place, winners)


def dedup_stats(df: DataFrame, surt: str = "surt_url") -> DataFrame:
    """Processed, unique, skipped over all rows offered to the dedup step."""
    k = normalize_surt(surt)
    return (df.agg(F.count(F.lit(1)).alias("processed"), F.count_distinct(k).alias("unique_urls"))
              .select("processed", "unique_urls",
                      (F.col("processed") - F.col("unique_urls")).alias("skipped")))


def dedup_incremental(df: DataFrame, seen: DataFrame, surt: str = "surt_url",
                      seen_key: str = "url_key", order=ORDER_FIRST_SEEN) -> DataFrame:
    """D3: drop URLs already in the persisted ``seen`` table, then D1.

    The anti join is a shuffle join of narrow rows on the key (AQE turns it
    into a broadcast only when the runtime size of ``seen`` is small).
    """
    place = unused("_place", df.columns)
    placed = df.withColumn(place, position(*order))
    narrow = placed.select(normalize_surt(surt).alias("_k"), place)
    fresh = narrow.join(seen.select(F.col(seen_key).alias("_k")), "_k", "left_anti")
    return _rows_at(placed, place, fresh.groupBy("_k").agg(F.min(place).alias(place)).select(place))


def seen_keys(df: DataFrame, surt: str = "surt_url") -> DataFrame:
    """The key table to append after a run (distinct keys, partial-aggregated)."""
    return df.select(normalize_surt(surt).alias("url_key")).distinct()


def append_seen_bucketed(kept: DataFrame, table: str, buckets: int, run_id: str = "", surt: str = "surt_url") -> None:
    """Append this run's keys (url_key, crawl, run_id) to a table bucketed (and
    sorted) by ``url_key``.

    With the seen table bucketed, the D3 anti join shuffles only the new
    entries into the same buckets; the ever-growing seen table is read in
    place, never shuffled.
    """
    spark = kept.sparkSession
    keys = kept.select(normalize_surt(surt).alias("url_key"), "crawl").distinct().withColumn("run_id", F.lit(run_id))
    writer = keys.write.bucketBy(buckets, "url_key").sortBy("url_key").format("parquet")
    if spark.catalog.tableExists(table):
        writer.mode("append").saveAsTable(table)
    else:
        writer.mode("overwrite").saveAsTable(table)


def read_seen(spark, table: str) -> DataFrame:
    """The bucketed seen-key table, or an empty one before the first run."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], "url_key string, crawl string, run_id string")
