"""Structured Streaming versions of both stages.

Worker (T1): the batches folder written by K2 is a file source; each
micro-batch decodes its messages (S6), fetches the archive records by
byte range (S5, P4), keeps responses (F6), extracts text (P5), filters
(F7, F8), tokenizes (P8), and ``foreachBatch`` writes the document
records (K1) to ``run=<batch_id>`` with overwrite, so a replayed
micro-batch rewrites the same folder (effectively once, T4), then
appends one audit row (A10).

Where the batches are those of stage-1 runs, the source is their commit log
instead of the folder: a micro-batch takes whole committed runs, so batches of a
run that died are never read, and a reset (also a commit) hides what its
crawl had before, in the batches still to be read and in the documents already
written (``read_worker_output``).

* T2 back-pressure: ``maxFilesPerTrigger`` (batch files, or commits).
* T3 time-bounded flush: ``trigger(processingTime=...)``; the count/size
  cut inside a micro-batch is B3.
* T5 streaming dedup: the index stage as a stream; the seen URLs are keyed
  state (RocksDB), so a micro-batch looks up its own keys and never reads
  the history (deterministic winner inside a micro-batch via D1's order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsieve.files import exists
from crawlsieve.operators import dedup, ledger
from crawlsieve.operators.batching import lane_of
from crawlsieve.plans.runs import COMMIT, RunStore, observed_rows, since_reset
from crawlsieve.sources import index as ixsrc
from crawlsieve.sources import sinks

AUDIT = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("rows", T.LongType()), T.StructField("files", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("attempt", T.StringType()),
    T.StructField("ms", T.LongType()),
])


def _start(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def start_worker(spark: SparkSession, batches_dir: str, out_dir: str, checkpoint: str,
                 archive_template: str, archive_base: str, vocab: list[str] | None = None,
                 max_files_per_trigger: int | None = None, trigger: str | None = "availableNow",
                 audit_dir: str | None = None, query_name: str = "worker", text_mode: str = "flat",
                 batches_format: str = "json", upload_lanes: int | None = None):
    """Start the worker stream; returns the StreamingQuery.

    T2: at most ``max_files_per_trigger`` batch files per micro-batch
    (default: one per task slot, i.e. one in-flight message per core); of
    stage-1 runs, that many commits (default: one).  With ``upload_lanes``
    references to the documents are published below ``<out_dir>_state/refs`` for the
    upload stream (T3, ``streaming.uploads``).
    """
    from crawlsieve.plans import jobs
    source = jobs.stage_one_root(spark, batches_dir)
    if source:
        spark.createDataFrame([(source,)], "root string").coalesce(1).write.mode("overwrite").parquet(f"{out_dir}_state/source")
        src = (spark.readStream.schema(f"{COMMIT}, run_id string")
                    .option("maxFilesPerTrigger", max_files_per_trigger or 1).parquet(f"{source}/commits"))
    else:
        src = (spark.readStream.schema(sinks.BATCH_ROW)
                    .option("maxFilesPerTrigger", max_files_per_trigger or spark.sparkContext.defaultParallelism)
                    .format(batches_format).load(batches_dir))
    audit_dir = audit_dir or f"{out_dir}_audit"

    def entries_of(batch: DataFrame) -> DataFrame:
        if source:
            batch = _batches_of_commits(spark, source, batch, batches_format)
        return ixsrc.explode_batch_messages(batch)

    def note(batch_id: int, attempt: str, status: str, rows: int = 0, files: int = 0, ms: int = 0):
        (spark.createDataFrame([(query_name, int(batch_id), rows, files, status, attempt, ms)], AUDIT).coalesce(1)
              .write.mode("append").parquet(audit_dir))

    def sink(batch: DataFrame, batch_id: int):
        import time
        import uuid
        attempt, began = uuid.uuid4().hex, time.monotonic()
        note(batch_id, attempt, "attempt")
        try:
            records_dir, target = f"{out_dir}_state/records/batch={batch_id}", f"{out_dir}/run={batch_id}"
            records = jobs.write_records(jobs.records_from_entries(entries_of(batch), archive_template, archive_base, text_mode),
                                         records_dir)
            jobs.rejects_of(records).write.mode("overwrite").parquet(f"{out_dir}_state/rejects/batch={batch_id}")
            written = Observation(f"{query_name}_{batch_id}_{attempt[:8]}")
            docs = jobs.documents_of(records, vocab, keep=sinks.ORIGIN).observe(written, F.count(F.lit(1)).alias("rows"))
            sinks.write_documents(sinks.by_day(docs), target, mode="overwrite", above=sinks.ORIGIN)
            n = observed_rows(written)
            files = len(sinks.read_documents(spark, target).inputFiles()) if n else 0     # listed, not opened
            if n and upload_lanes:
                from crawlsieve.streaming import uploads
                uploads.publish_refs(sinks.read_documents(spark, target), f"{out_dir}_state/refs", str(batch_id),
                                     lane=lane_of(F.col("url"), upload_lanes), source=F.lit(batch_id), key=document_id(), chars=F.col("char_count"))
        except Exception:
            note(batch_id, attempt, "failed", ms=round(1000 * (time.monotonic() - began)))
            raise
        note(batch_id, attempt, "ok", n, int(files), round(1000 * (time.monotonic() - began)))

    writer = (src.writeStream.queryName(query_name)
                 .option("checkpointLocation", checkpoint)
                 .foreachBatch(sink))
    return _start(writer, trigger)


def document_id():
    """What names a document inside a micro-batch."""
    return F.concat_ws(" ", "url", "timestamp")


def documents_of_batches(spark: SparkSession, out_dir: str):
    """For ``uploads.start_uploads``: the documents of the micro-batches named, with ``source`` and ``id``."""
    def read(sources: list[str]) -> DataFrame:
        docs = read_worker_output(spark, out_dir, sources)
        return docs.withColumn("source", F.col("run")).withColumn("id", document_id()).drop("run")
    return read


def _batches_of_commits(spark: SparkSession, source: str, commits: DataFrame, batches_format: str) -> DataFrame:
    """Batch messages of the runs that these commits end, without those of crawls reset since."""
    store = RunStore(spark, source)
    runs = commits.where("kind = 'run'").select("run_id", "seq")
    ids = [r["run_id"] for r in runs.collect()]         # at most maxFilesPerTrigger
    messages = sinks.read_batches(spark, f"{source}/batches", batches_format).where(F.col("run_id").isin(ids))
    from crawlsieve.plans.jobs import STATUS
    return since_reset(messages.join(runs, "run_id"), ledger.latest_resets(store.rows("status", STATUS)))


def read_worker_output(spark: SparkSession, out_dir: str, only: list[str] | None = None) -> DataFrame:
    """Documents of the stream (or of the micro-batches named); those from before a reset
    of their crawl do not count."""
    from crawlsieve.plans import jobs
    docs = sinks.read_documents(spark, out_dir, runs=True, run="run", only=only)
    state = f"{out_dir}_state/source"
    if not exists(spark, state):
        return docs
    return jobs.still_valid(spark, docs, spark.read.schema("root string").parquet(state).first()["root"])


def read_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """What the stream could not fetch or read, with the reason."""
    from crawlsieve.plans import jobs
    return spark.read.schema(jobs.REJECT).parquet(f"{out_dir}_state/rejects")


def read_audit(spark: SparkSession, audit_dir: str) -> DataFrame:
    """One row per event: every try of a micro-batch writes ``attempt``, then
    ``ok`` or ``failed`` (a try that was killed has only the first)."""
    return spark.read.schema(AUDIT).parquet(audit_dir)


def batch_times(spark: SparkSession, audit_dir: str) -> DataFrame:
    """Time of every finished micro-batch, from the audit table."""
    return read_audit(spark, audit_dir).where("status = 'ok'").groupBy("query", "batch_id").agg(
        F.max("ms").alias("ms"), F.max("rows").alias("rows"))


# --- T5 ----------------------------------------------------------------------------

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def start_index_dedup(spark: SparkSession, lines_dir: str, out_dir: str, seen_dir: str, checkpoint: str,
                      parse_fn, max_files_per_trigger: int | None = None, trigger: str | None = "availableNow",
                      query_name: str = "index_dedup"):
    """T5: stream of index lines -> parse/filter (``parse_fn``) -> the first row of
    every URL that no earlier micro-batch had, appended to ``out_dir``.

    The state holds per URL key its first row and the times of the first and last
    micro-batch that had it; it is a streaming aggregation, so rows of one URL are
    reduced before the shuffle, and a micro-batch touches the state of its own keys
    only.  A key is new where both times are this micro-batch's.  The time of a
    micro-batch is in its offset log, so a replay gives the same rows.  Keys are
    also written to ``seen_dir`` for batch runs (D3); the stream never reads them.
    """
    reader = spark.readStream.schema(spark.read.parquet(lines_dir).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    passed = parse_fn(reader.parquet(lines_dir))
    now = F.current_timestamp()         # the time of the micro-batch
    row, order = F.struct(*passed.columns), F.struct("_now", *dedup.ORDER_FIRST_SEEN)
    state = dedup.with_dedup_key(passed).withColumn("_now", now).groupBy("url_key").agg(
        F.min_by(row, order).alias("row"), F.min("_now").alias("first"), F.max("_now").alias("last"))
    fresh = state.where((F.col("first") == now) & (F.col("last") == now)).select("url_key", "row.*")

    def sink(batch: DataFrame, batch_id: int):
        path = f"{out_dir}/batch_id={batch_id}"
        batch.drop("url_key").write.mode("overwrite").parquet(path)     # the one pass over the state
        dedup.seen_keys(spark.read.schema(passed.schema).parquet(path)).write.mode("overwrite").parquet(f"{seen_dir}/batch_id={batch_id}")

    writer = (fresh.writeStream.queryName(query_name).outputMode("update")
                   .option("checkpointLocation", checkpoint).foreachBatch(sink))
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)           # read when the stream starts
    try:
        return _start(writer, trigger)
    finally:
        spark.conf.set(PROVIDER, before)
