"""Pipeline metrics (A1-A8, A10) as aggregate DataFrames.

Counters become ``count_if`` columns of one grouped aggregation, so each
funnel is a single partial-aggregated pass.  ``observe_funnel`` exposes
the same numbers live while a write runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from crawlsieve.functions.cdx import normalize_surt
from crawlsieve.functions.text import is_nonblank
from crawlsieve.operators.dedup import ORDER_FIRST_SEEN
from crawlsieve.operators.ledger import batch_key

INDEX_OUTCOMES = ("parse_error", "language", "status")


def funnel_index(with_outcome: DataFrame, group=("crawl",), surt: str = "surt_url",
                 dedup: bool = True, order=ORDER_FIRST_SEEN) -> DataFrame:
    """A1: per crawl: total, parse_error, language, status, duplicate, kept.

    ``total = parse_error + language + status + duplicate + kept``.
    Duplicates are passes that lose D1; only the winner count per crawl
    is needed, so D1 runs on a narrow (key, order, crawl) projection.
    """
    g = list(group)
    if dedup and g == ["crawl"] and order[0] == "crawl_rank":
        return _funnel_by_rank(with_outcome, surt)
    counts = with_outcome.groupBy(*g).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in INDEX_OUTCOMES],
        F.count_if(F.col("outcome") == "pass").alias("_pass"))
    if dedup:
        winners = (with_outcome.where(F.col("outcome") == "pass")
                   .select(normalize_surt(surt).alias("_k"),
                           F.struct(*[F.col(c) for c in order], *[F.col(c) for c in g]).alias("_o"))
                   .groupBy("_k").agg(F.min("_o").alias("_w"))
                   .groupBy(*[F.col(f"_w.{c}").alias(c) for c in g])
                   .agg(F.count(F.lit(1)).alias("_kept")))
        counts = counts.join(winners, g, "left").withColumn("_kept", F.coalesce("_kept", F.lit(0)))
    else:
        counts = counts.withColumn("_kept", F.col("_pass"))
    return counts.select(*g, F.col("total").cast("bigint"),
                         *[F.col(o).cast("bigint") for o in INDEX_OUTCOMES],
                         (F.col("_pass") - F.col("_kept")).cast("bigint").alias("duplicate"),
                         F.col("_kept").cast("bigint").alias("kept"))


def _funnel_by_rank(with_outcome: DataFrame, surt: str) -> DataFrame:
    """Fast path when the first-seen order starts with the crawl rank: the
    winning crawl of a URL is its minimum rank, so D1 for counting is a
    fixed-width ``min(int)`` hash aggregation (partial, no sort)."""
    counts = with_outcome.groupBy("crawl", "crawl_rank").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in INDEX_OUTCOMES],
        F.count_if(F.col("outcome") == "pass").alias("_pass"))
    winners = (with_outcome.where(F.col("outcome") == "pass")
               .groupBy(normalize_surt(surt).alias("_k")).agg(F.min("crawl_rank").alias("crawl_rank"))
               .groupBy("crawl_rank").agg(F.count(F.lit(1)).alias("_kept")))
    counts = counts.join(winners, "crawl_rank", "left").withColumn("_kept", F.coalesce("_kept", F.lit(0)))
    return counts.select("crawl", F.col("total").cast("bigint"),
                         *[F.col(o).cast("bigint") for o in INDEX_OUTCOMES],
                         (F.col("_pass") - F.col("_kept")).cast("bigint").alias("duplicate"),
                         F.col("_kept").cast("bigint").alias("kept"))


def observe_funnel(with_outcome: DataFrame, name: str = "index_funnel"):
    """Attach live counters to a DataFrame; read ``obs.get`` after an action."""
    obs = Observation(name)
    df = with_outcome.observe(obs, F.count(F.lit(1)).alias("total"),
                              *[F.count_if(F.col("outcome") == o).alias(o)
                                for o in (*INDEX_OUTCOMES, "pass", "fetch_error", "blank")])
    return df, obs


def funnel_documents(records: DataFrame, group=("filename",)) -> DataFrame:
    """A2: per group: ranges fetched, download errors, records, responses,
    extraction attempted / non-empty, length-filtered, successful (after
    the length filter).  Tokenized / written counts of the worker job are
    live observations (``plans.jobs.run_worker``).

    ``records`` carries ``warc_type``, ``text`` (extracted, may be null) and
    ``keep_length`` (bool) columns.
    """
    is_resp = F.col("warc_type") == "response"
    nonblank = is_nonblank("text")
    fetched = F.col("record_no") >= 0
    return records.groupBy(*group).agg(
        F.count_distinct(F.when(fetched, F.col("offset"))).cast("bigint").alias("ranges_fetched"),
        F.count_if(F.col("record_no") == -1).cast("bigint").alias("download_errors"),
        F.count_if(fetched & F.col("warc_type").isNotNull()).cast("bigint").alias("records_total"),
        F.count_if(is_resp).cast("bigint").alias("responses"),
        F.count_if(is_resp).cast("bigint").alias("extractions_attempted"),
        F.count_if(is_resp & nonblank).cast("bigint").alias("extractions_nonblank"),
        F.count_if(is_resp & nonblank & ~F.col("keep_length")).cast("bigint").alias("filtered_length"),
        F.count_if(is_resp & nonblank & F.col("keep_length")).cast("bigint").alias("extractions_successful"))


def errors_by_type(df: DataFrame, error: str = "error") -> DataFrame:
    """A3: rows per error label (rows without error are not counted)."""
    return df.where(F.col(error).isNotNull()).groupBy(F.col(error).alias("error_type")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def bytes_by_file(df: DataFrame, file: str, compressed: str, decompressed: str, group=()) -> DataFrame:
    """A4: compressed bytes requested and decompressed bytes obtained per file."""
    return df.groupBy(*group, F.col(file).alias("file")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_ranges"),
        F.sum(compressed).cast("bigint").alias("bytes_compressed"),
        F.coalesce(F.sum(decompressed), F.lit(0)).cast("bigint").alias("bytes_decompressed"))


def total_blocks(index: DataFrame) -> DataFrame:
    """A5: highest block id per crawl (ids increment from 1)."""
    return index.groupBy("crawl").agg(F.max("block_id").cast("bigint").alias("total_blocks"))


def batch_counts(batches: DataFrame, group=("crawl",), batch: str = "batch_no") -> DataFrame:
    """Batches published per crawl, over all runs."""
    return batches.groupBy(*group).agg(F.count_distinct(batch_key(batches, batch)).cast("bigint").alias("batches"))
