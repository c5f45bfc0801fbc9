"""Run state (K3-K5) and progress metrics.

The resume unit is the index block.  A run appends one ledger row per
fetched block: ``done`` or ``failed`` with the rows read and kept.  The
next run fetches the index rows that have no ``done`` row (anti join on
``(crawl, block_id)``), so failed blocks stay eligible.

Crawl status is an append-only event table; the current state is the
latest event per crawl (``max_by``), where ``reset`` means ``pending``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_DONE, BLOCK_FAILED = "done", "failed"


def block_ledger(blocks: DataFrame, lines: DataFrame | None = None, kept: DataFrame | None = None,
                 run_id: str | None = None) -> DataFrame:
    """Ledger rows for one run from the S3 output (one row per block).

    ``lines``/``kept`` (crawl, block_id rows) add per-block counts; both
    are aggregated before the join, so only per-block rows are joined.
    """
    led = blocks.select("crawl", "block_id",
                        F.when(F.col("error").isNull(), F.lit(BLOCK_DONE)).otherwise(F.lit(BLOCK_FAILED)).alias("status"),
                        "error")
    for name, df in (("rows_in", lines), ("rows_kept", kept)):
        if df is not None:
            c = df.groupBy("crawl", "block_id").agg(F.count(F.lit(1)).cast("bigint").alias(name))
            led = led.join(c, ["crawl", "block_id"], "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))
    if run_id is not None:
        led = led.withColumn("run_id", F.lit(run_id))
    return led


def pending_blocks(index: DataFrame, ledger: DataFrame) -> DataFrame:
    """K3: index rows still to fetch (no ``done`` ledger row)."""
    done = ledger.where(F.col("status") == BLOCK_DONE).select("crawl", "block_id").distinct()
    return index.join(done, ["crawl", "block_id"], "left_anti")


def batch_key(batches: DataFrame, batch: str = "batch_no"):
    """What tells batches apart: numbers restart in every run."""
    run = F.coalesce("run_id", F.lit("")) if "run_id" in batches.columns else F.lit("")
    return F.struct(run.alias("run"), F.col(batch).alias("no"))


def crawl_progress(index: DataFrame, ledger: DataFrame, batches: DataFrame | None = None) -> DataFrame:
    """Per crawl: total blocks, done blocks, percent (same unit both
    sides), and batches published when a batches table is given."""
    total = index.groupBy("crawl").agg(F.count_distinct("block_id").cast("bigint").alias("total_blocks"))
    done = (ledger.where(F.col("status") == BLOCK_DONE).groupBy("crawl")
                  .agg(F.count_distinct("block_id").cast("bigint").alias("done_blocks")))
    out = (total.join(done, "crawl", "left")
                .withColumn("done_blocks", F.coalesce("done_blocks", F.lit(0)).cast("bigint"))
                .withColumn("progress_percent",
                            F.when(F.col("total_blocks") > 0,
                                   F.round(F.lit(100.0) * F.col("done_blocks") / F.col("total_blocks"), 4))))
    if batches is not None:
        b = batches.groupBy("crawl").agg(F.count_distinct(batch_key(batches)).cast("bigint").alias("batches_published"))
        out = out.join(b, "crawl", "left").withColumn("batches_published",
                                                       F.coalesce("batches_published", F.lit(0)).cast("bigint"))
    return out


def status_events_from_ledger(ledger: DataFrame, start_ts=None, pending: DataFrame | None = None,
                              end_ts=None) -> DataFrame:
    """K4 events a run appends: ``in_progress`` at start (step 0), then (step 1)
    ``error`` if a block failed, else ``completed`` when no index block is left
    pending (``pending``: index rows still to fetch), else it stays
    ``in_progress``.  Times default to now."""
    t0 = F.current_timestamp() if start_ts is None else F.lit(start_ts).cast("timestamp")
    t1 = F.current_timestamp() if end_ts is None else F.lit(end_ts).cast("timestamp")
    per = ledger.groupBy("crawl").agg(F.count_if(F.col("status") == BLOCK_FAILED).alias("_failed"))
    if pending is not None:
        left = pending.groupBy("crawl").agg(F.count(F.lit(1)).alias("_left"))
        per = per.join(left, "crawl", "left").withColumn("_left", F.coalesce("_left", F.lit(0)))
    else:
        per = per.withColumn("_left", F.lit(0))
    end = (F.when(F.col("_failed") > 0, F.lit("error")).when(F.col("_left") > 0, F.lit("in_progress"))
            .otherwise(F.lit("completed")))
    return per.select("crawl", F.explode(F.array(
        F.struct(F.lit("in_progress").alias("status"), t0.alias("event_ts"), F.lit(0).alias("step")),
        F.struct(end.alias("status"), t1.alias("event_ts"), F.lit(1).alias("step")))).alias("e")).select("crawl", "e.*")


def reset_events(crawls: DataFrame, ts=None) -> DataFrame:
    """K5: a ``reset`` event per given crawl (fresh start)."""
    at = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
    return crawls.select("crawl", F.lit("reset").alias("status"), at.alias("event_ts"), F.lit(0).alias("step"))


def latest_resets(events: DataFrame) -> DataFrame:
    """(crawl, reset_seq) of the crawls that were ever reset."""
    return events.where(F.col("status") == "reset").groupBy("crawl").agg(F.max("seq").alias("reset_seq"))


def current_crawl_status(events: DataFrame, crawls: DataFrame | None = None) -> DataFrame:
    """K4: latest event per crawl by (seq, step) - run sequence and place in the
    run - then time; ``reset`` -> ``pending``; crawls with no event (missing or
    unreadable state) are ``pending``."""
    order = [F.col(c) for c in ("seq", "step", "event_ts") if c in events.columns]
    latest = (events.groupBy("crawl")
                    .agg(F.max_by("status", F.struct(*order)).alias("status"))
                    .withColumn("status", F.when(F.col("status") == "reset", F.lit("pending")).otherwise(F.col("status"))))
    if crawls is not None:
        latest = (crawls.select("crawl").join(latest, "crawl", "left")
                        .withColumn("status", F.coalesce("status", F.lit("pending"))))
    return latest


def crawls_to_run(crawls: DataFrame, events: DataFrame) -> DataFrame:
    """Skip completed crawls (anti join on the current status); ``crawls``
    is any DataFrame with a ``crawl`` column (a crawl list or index rows)."""
    done = current_crawl_status(events).where(F.col("status") == "completed").select("crawl")
    return crawls.join(done, "crawl", "left_anti")


def run_summary(status: DataFrame) -> DataFrame:
    """Crawls per status."""
    return status.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n_crawls"))
