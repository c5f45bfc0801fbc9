"""The two pipeline stages as batch jobs over written tables.

Stage 1 (``run_batcher``): block index -> pending blocks (K3) -> ranged
block reads (S3/S4) -> parse + filters (P1, F1-F5) -> dedup against the
seen table and first-seen winner (D3, D1) -> written ``kept`` table ->
fixed-size batches (B1) -> messages (B4) -> batches table (K2), plus the
block ledger, seen keys, funnel counts and crawl-status events.

Stage 2 (``run_worker``): batches table -> entries (S6) -> archive records
(S5, P4) -> responses (F6) -> text (P5 or P6/P7) -> non-blank and length
filters (F7, F8) -> tokens (P8) -> records (P9) -> upload batch numbers
(B3) -> date-partitioned Parquet, a file per upload batch (K1).  A document knows
the stage-1 run and crawl it came from, so a reset of the crawl reaches it.

Every intermediate that more than one branch reads is a written table in
the shared folder, so lineage is cut there and a lost executor only
recomputes its own stage.  Outputs are written per run and become visible
with one commit row (``plans.runs``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsieve.files import exists
from crawlsieve.functions import text as textf
from crawlsieve.functions.cdx import meta
from crawlsieve.operators import batching, dedup, extract, ledger, metrics, threshold, tokenize
from crawlsieve.plans import index_stage
from crawlsieve.plans.runs import RunStore, since_reset
from crawlsieve.sources import index as ixsrc
from crawlsieve.sources import ranged, sinks


STATUS = "crawl string, status string, event_ts timestamp, step int"
LEDGER = ("crawl string, block_id long, status string, error string, rows_in long, parse_error long, language long, "
          "status_code long, passed long, rows_kept long")
SEEN = "url_key string, crawl string"


def run_batcher(spark: SparkSession, crawls, index_template: str, block_template: str, base: str,
                out_dir: str, batch_size: int = 50, dedup_urls: bool = True, max_blocks: int | None = None,
                run_id: str | None = None, seen_table: str | None = None, seen_buckets: int = 512,
                metrics_out: dict | None = None, batches_format: str = "json",
                **filter_kw) -> dict[str, str]:
    """Stage 1.  Returns the paths written: this run's own folders (``parsed``,
    ``kept``, ``funnel``) and the tables of all runs.

    A run may follow any other run, finished or not: it takes the blocks that no
    committed run has done since the crawl's latest reset, drops the URLs those
    runs kept, writes everything to its own folders and becomes visible with
    one commit row at the end (``plans.runs``).  ``run_id`` defaults to a new id;
    a run that died is repeated under its id.

    ``metrics_out`` (a dict) receives the live line counters observed while
    the parsed table is written: total, per outcome, and fetch errors.

    ``seen_table`` names a catalog table bucketed by URL key that holds the
    keys of all earlier runs (D3 without shuffling it); without it the seen
    keys are a Parquet table under ``out_dir``.

    The ranged fetch runs exactly once: fetched blocks are exploded into
    lines, parsed and labelled, and written as the ``parsed`` table (a failed
    block keeps one row with its error, a block without lines one ``blank``
    row).  One aggregation of that table per block gives ledger and funnel.
    """
    store = RunStore(spark, out_dir, run_id)
    events = store.rows("status", STATUS)
    resets = ledger.latest_resets(events)
    earlier = since_reset(store.rows("ledger", LEDGER), resets)
    named = ixsrc.read_block_index(spark, crawls, index_template, base)
    index = named if max_blocks is None else named.where(F.col("block_id").between(0, max_blocks))
    index = ledger.pending_blocks(ledger.crawls_to_run(index, events), earlier)      # K4, K3
    blocks = ranged.read_blocks(index, block_template, base)
    ranks = ixsrc.crawl_table(spark, crawls)          # one row per named crawl
    line = F.coalesce("line", F.lit(""))
    exploded = (blocks.select("crawl", "block_id", "error",
                              F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
                      .where(F.col("error").isNotNull() | (line != "") | (F.col("line_no") == 0))
                      .join(F.broadcast(ranks), "crawl"))
    parsed = index_stage.parsed_lines(exploded.withColumn("line", line), **filter_kw)
    labelled = parsed.withColumn("outcome", F.when(F.col("error").isNotNull(), F.lit("fetch_error"))
                                            .when(F.col("line") == "", F.lit("blank"))
                                            .otherwise(F.col("outcome")))
    labelled, obs = metrics.observe_funnel(labelled, name=f"batcher_{store.run_id}_{uuid.uuid4().hex[:8]}")
    parsed = store.write("parsed", labelled.drop("line"))     # lineage cut: the fetch never reruns
    if metrics_out is not None:
        metrics_out.update(obs.get)

    passed = parsed.where("outcome = 'pass'").select(*index_stage.LINEAGE, "surt_url", "timestamp", "metadata")
    kept = passed
    if dedup_urls:
        seen = store.committed(dedup.read_seen(spark, seen_table)) if seen_table else store.rows("seen", SEEN)
        kept = dedup.dedup_incremental(passed, since_reset(seen, resets).select("url_key"))
    kept = store.write("kept", kept)                  # branches below are pruned scans

    def outcome(name: str):
        return F.count_if(F.col("outcome") == name).cast("bigint")

    per_block = parsed.groupBy("crawl", "block_id").agg(
        F.max("error").alias("error"), F.count_if(~F.col("outcome").isin("fetch_error", "blank")).cast("bigint").alias("rows_in"),
        *[outcome(o).alias(c) for o, c in (("parse_error", "parse_error"), ("language", "language"),
                                           ("status", "status_code"), ("pass", "passed"))])
    kept_rows = kept.groupBy("crawl", "block_id").agg(F.count(F.lit(1)).cast("bigint").alias("rows_kept"))
    led = (per_block.join(kept_rows, ["crawl", "block_id"], "left")
           .withColumn("rows_kept", F.coalesce("rows_kept", F.lit(0)).cast("bigint"))
           .withColumn("status", F.when(F.col("error").isNull(), F.lit(ledger.BLOCK_DONE))
                                  .otherwise(F.lit(ledger.BLOCK_FAILED))))
    led = led.select("crawl", F.col("block_id").cast("bigint").alias("block_id"), "status", "error",
                     "rows_in", "parse_error", "language", "status_code", "passed", "rows_kept")
    store.audited("ledger", led, lambda df: store.write("ledger", df))
    led = spark.read.schema(LEDGER).parquet(store.path("ledger"))
    store.write("funnel", led.groupBy("crawl").agg(
        F.sum("rows_in").alias("total"), F.sum("parse_error").alias("parse_error"), F.sum("language").alias("language"),
        F.sum("status_code").alias("status"), (F.sum("passed") - F.sum("rows_kept")).alias("duplicate"),
        F.sum("rows_kept").alias("kept")))
    if dedup_urls and seen_table:
        dedup.append_seen_bucketed(kept, seen_table, seen_buckets, store.run_id)
    elif dedup_urls:
        store.write("seen", kept.select(dedup.normalize_surt("surt_url").alias("url_key"), "crawl").distinct())
    done = earlier.select("crawl", "block_id", "status").unionByName(led.select("crawl", "block_id", "status"))
    store.write("status", ledger.status_events_from_ledger(led, pending=ledger.pending_blocks(named, done)))
    store.audited("batches", batching.batch_messages(batching.batch_fixed_size(kept, batch_size)),
                  lambda df: sinks.write_batches(df, store.path("batches"), mode="overwrite", fmt=batches_format))
    store.commit()
    own = {k: store.path(k) for k in ("parsed", "kept", "funnel")}
    return {**own, **{k: f"{store.root}/{k}" for k in ("batches", "ledger", "seen", "status")}, "root": store.root}


def reset_crawls(spark: SparkSession, out_dir: str, crawls) -> None:
    """K5: the named crawls start over: their ledger rows, seen keys and batches
    of earlier runs no longer count."""
    store = RunStore(spark, out_dir)
    store.write("status", ledger.reset_events(ixsrc.crawl_table(spark, crawls)))
    store.commit("reset")


def crawl_status(spark: SparkSession, out_dir: str) -> DataFrame:
    """K4: current status of every crawl that any committed run or reset named."""
    return ledger.current_crawl_status(RunStore(spark, out_dir).rows("status", STATUS))


def published_batches(spark: SparkSession, out_dir: str, fmt: str = "json") -> DataFrame:
    """Batch messages of committed runs since each crawl's latest reset."""
    store = RunStore(spark, out_dir)
    batches = store.committed(sinks.read_batches(spark, f"{store.root}/batches", fmt))
    return since_reset(batches, ledger.latest_resets(store.rows("status", STATUS)))


RECORD = ("surt_url string, timestamp string, source_run string, crawl string, filename string, offset long, length long, "
          "record_no int, warc_type string, error string, full_text string, record_id long")
CONSUMED = "source_run string, crawl string, batch_no long"
REJECT = "surt_url string, timestamp string, filename string, offset long, length long, error string"


def records_from_entries(entries: DataFrame, archive_template: str, archive_base: str, text_mode: str = "flat") -> DataFrame:
    """Entries (surt_url, timestamp, metadata) -> archive records by range (S5,
    P4), one row per record with the text of responses (P5, or P6/P7 with
    ``text_mode`` 'main' / 'strict') and the error of what failed."""
    carry = ["surt_url", "timestamp", *sinks.ORIGIN]
    manifest = with_origin(entries).select(*carry, meta("filename").alias("filename"),
                              meta("offset").try_cast("bigint").alias("offset"),
                              meta("length").try_cast("bigint").alias("length"))
    scanned = ranged.read_archive_records(manifest, archive_template, archive_base, carry=carry)
    key = [*carry, "filename", "offset", "length", "record_no", "warc_type", "error"]
    good = (F.col("warc_type") == "response") & F.col("error").isNull()
    if text_mode == "flat":
        body = F.when(good, textf.flat_text("body"))
        return textf.with_computed(scanned.select(*key, "body"), body, "full_text").drop("body")
    if text_mode in ("main", "strict"):
        fn = extract.main_text_strict if text_mode == "strict" else extract.main_text
        held = scanned.select(*key, F.when(good, F.col("body")).alias("body"))
        return fn(held, id_cols=key, html="body", out="full_text")
    raise ValueError(f"text_mode must be 'flat', 'main' or 'strict', got {text_mode!r}")


def with_origin(entries: DataFrame) -> DataFrame:
    """Entries with ``source_run`` and ``crawl``; null where the batches do not name them."""
    if "source_run" not in entries.columns:
        entries = entries.withColumn("source_run", F.col("run_id") if "run_id" in entries.columns else F.lit(None).cast("string"))
    return entries if "crawl" in entries.columns else entries.withColumn("crawl", F.lit(None).cast("string"))


def write_records(records: DataFrame, path: str) -> DataFrame:
    """The written records, each with an id: the fetch never reruns."""
    records.withColumn("record_id", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    return records.sparkSession.read.schema(RECORD).parquet(path)


def rejects_of(records: DataFrame) -> DataFrame:
    """Entries that failed, with the reason."""
    return records.where(F.col("error").isNotNull()).select("surt_url", "timestamp", "filename", "offset", "length", "error")


def documents_of(records: DataFrame, vocab: list[str] | None, min_chars: int = 500, max_chars: int = 1_000_000,
                 max_tokens: int = 512, keep=()) -> DataFrame:
    """Responses (F6) with text -> non-blank and length filters (F7, F8), tokens
    (P8) and the record columns (P9), then the columns of the records to keep."""
    docs = records.where((F.col("warc_type") == "response") & F.col("error").isNull()).select(
        *dict.fromkeys(("surt_url", "timestamp", "filename", "full_text", *keep)))
    docs = textf.filter_length(textf.filter_nonblank(docs, "full_text"), "full_text", min_chars, max_chars)
    if vocab is None:
        return textf.document_records(docs, tokens=None, keep=keep)
    return textf.document_records(tokenize.tokenize(docs, vocab, text="full_text", max_tokens=max_tokens), keep=keep)


def documents_from_entries(entries: DataFrame, archive_template: str, archive_base: str, vocab: list[str] | None,
                           text_mode: str = "flat", min_chars: int = 500, max_chars: int = 1_000_000,
                           max_tokens: int = 512) -> DataFrame:
    """Both steps above as one plan."""
    records = records_from_entries(entries, archive_template, archive_base, text_mode)
    return documents_of(records, vocab, min_chars, max_chars, max_tokens)


def worker_counters(records: DataFrame, min_chars: int, max_chars: int) -> DataFrame:
    """Stage-2 counters over the written records, in one aggregation."""
    response = (F.col("warc_type") == "response") & F.col("error").isNull()
    text = response & textf.is_nonblank("full_text")

    def n(condition) -> F.Column:
        return F.count_if(condition).cast("bigint")

    return records.agg(
        n(F.col("record_no") == 0).alias("ranges_fetched"), n(F.col("record_no") == -1).alias("download_errors"),
        n(F.col("warc_type").isNotNull()).alias("records_total"), n(F.col("warc_type") == "response").alias("responses"),
        n(F.col("error").isNotNull() & (F.col("record_no") >= 0)).alias("record_errors"),
        n(response).alias("extractions_attempted"), n(text).alias("extractions_nonblank"),
        n(text & ~textf.length_ok("full_text", min_chars, max_chars)).alias("filtered_length"),
        n(text & textf.length_ok("full_text", min_chars, max_chars)).alias("documents"))


def run_worker(spark: SparkSession, batches_dir: str, archive_template: str, archive_base: str,
               out_dir: str, vocab: list[str] | None, text_mode: str = "flat", lanes: int | None = None,
               max_docs: int = 10_000, max_bytes: float = 256 * 1024 * 1024, min_chars: int = 500,
               max_chars: int = 1_000_000, max_tokens: int = 512, metrics_out: dict | None = None,
               batches_format: str = "json", run_id: str | None = None, date_from: str | None = "timestamp") -> str:
    """Stage 2.  Writes documents below ``out_dir`` (K1) and returns it.

    A run takes the batches that no committed run has consumed (and, where the
    batches folder belongs to stage-1 runs, only committed ones), writes every
    fetched record with its text or error once, and from that table the
    documents, the rejects and the counters; one commit row ends it.  The
    state lies in ``<out_dir>_state``; ``worker_documents`` reads what is committed
    and no older than its crawl's latest reset.

    Upload batches close at ``max_docs`` documents or ``max_bytes`` estimated bytes
    (B3).  Their lanes are (stage-1 run, crawl, day), with ``lanes`` also a hash of
    the URL; a batch is one file (K1).  Numbers are found from lengths alone
    and joined to the documents by record id.  ``date_from=None`` lays files out by
    processing date.

    ``metrics_out`` (a dict) receives the worker counters.
    """
    store = RunStore(spark, f"{out_dir}_state", run_id)
    messages = sinks.read_batches(spark, batches_dir, batches_format)
    source = stage_one_root(spark, batches_dir)
    if source:
        messages = published_batches(spark, source, batches_format)
    known = {r["root"] for r in store.rows("source", "root string").collect()}     # one row per committed run
    if known - {source or ""}:
        raise ValueError(f"{out_dir!r} holds documents of other batches: {sorted(known)}")
    store.write("source", spark.createDataFrame([(source or "",)], "root string"))
    done = store.rows("consumed", CONSUMED).select("source_run", F.col("crawl").alias("_c"), F.col("batch_no").alias("_b"))
    messages = messages.join(done, F.col("run_id").eqNullSafe(F.col("source_run")) & (F.col("crawl") == F.col("_c"))
                             & (F.col("batch_no") == F.col("_b")), "left_anti")
    taken = store.write("consumed", messages.select(F.col("run_id").alias("source_run"), "crawl", "batch_no", "n", "body"))
    entries = ixsrc.explode_batch_messages(taken, keep=("source_run", "crawl", "batch_no"))
    records = write_records(records_from_entries(entries, archive_template, archive_base, text_mode), store.path("records"))
    store.write("rejects", rejects_of(records))
    counters = store.write("counters", worker_counters(records, min_chars, max_chars))
    folders = [*sinks.ORIGIN] + (["lane"] if lanes else [])

    def placed(docs: DataFrame) -> DataFrame:
        docs = sinks.with_date_parts(docs, date_from)
        return docs.withColumn("lane", batching.lane_of(F.col("url"), lanes)) if lanes else docs

    keep = (*sinks.ORIGIN, "record_id")
    lane = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*folders, *sinks.DATE_PARTS)])
    narrow = placed(documents_of(records, None, min_chars, max_chars, keep=keep)).select(
        lane.alias("_lane"), "url", "timestamp", "char_count", "record_id")
    numbers = threshold.batch_numbers(narrow, "_lane", ("url", "timestamp"), F.col("char_count"), max_docs, max_bytes, "record_id")
    numbers = numbers.select(F.col("id").alias("record_id"), F.col("number").alias("upload_batch_no"))
    documents = placed(documents_of(records, vocab, min_chars, max_chars, max_tokens, keep=keep))
    store.audited("documents", documents.join(numbers, "record_id").drop("record_id"),
                  lambda df: sinks.write_uploads(df, f"{out_dir}/run_id={store.run_id}", above=folders, mode="overwrite"))
    if metrics_out is not None:
        metrics_out.update(counters.first().asDict())
        metrics_out["documents_written"] = metrics_out.pop("documents")
    store.commit()
    return out_dir


def stage_one_root(spark: SparkSession, batches_dir: str) -> str | None:
    """The folder of the stage-1 runs that write these batches, if they are such."""
    root = batches_dir.rstrip("/").rpartition("/")[0]
    return root if exists(spark, f"{root}/commits") else None


def still_valid(spark: SparkSession, docs: DataFrame, source: str | None) -> DataFrame:
    """Documents of stage-1 runs that are newer than their crawl's latest reset."""
    if not source:
        return docs
    store = RunStore(spark, source)
    runs = store.commits().where("kind = 'run'").select(F.col("run_id").alias("source_run"), "seq")
    fresh = since_reset(docs.join(runs, "source_run"), ledger.latest_resets(store.rows("status", STATUS)))
    return fresh.select(docs.columns)


def worker_documents(spark: SparkSession, out_dir: str) -> DataFrame:
    """Documents of committed runs; those from before a reset of their crawl do not count."""
    store = RunStore(spark, f"{out_dir}_state")
    ids = [r["run_id"] for r in store.commits().select("run_id").collect()]
    docs = sinks.read_documents(spark, out_dir, runs=True, only=ids)
    sources = [r["root"] for r in store.rows("source", "root string").select("root").distinct().collect()]
    return still_valid(spark, docs, sources[0] if sources else None)


def worker_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """What committed runs could not fetch or read, with the reason."""
    return RunStore(spark, f"{out_dir}_state").rows("rejects", REJECT)
