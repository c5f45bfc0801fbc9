"""Upload batches that span micro-batches (T3, B3, K1 as a stream).

References to documents (lane, run folder, position, length; no text) arrive as folders
that are published whole.  Per lane the open batch is streaming state: it closes when it
holds ``max_docs`` documents or ``max_bytes`` estimated bytes, when a processing-time timer
finds it ``max_seconds`` old, or on a flush (graceful end: no tail is lost).  A
closed batch leaves the state with all its references; the sink joins them to the documents
and writes one file per batch.  The state is bounded by ``max_docs`` references a lane.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from crawlsieve.files import exists
from crawlsieve.operators.threshold import Cuts
from crawlsieve.session import scratch_path
from crawlsieve.streaming.worker import PROVIDER, ROCKSDB, _start

REF = "lane string, source string, id string, chars long, flush boolean"
CLOSED = "lane string, upload_batch_no long, reason string, source string, id string, chars long"
STATE = "number long, opened long, refs string"
COUNT, BYTES, TIME, FLUSH = "count", "bytes", "time", "flush"


def publish(df: DataFrame, folder: str, name: str) -> bool:
    """Make ``df`` appear as ``folder/name`` at once, or not at all where it is there
    already (a replay).  Needs a file system with atomic renames."""
    spark = df.sparkSession
    path = f"{folder}/part={name}"
    if exists(spark, path):
        return False
    staged = scratch_path(spark, "staged")
    df.write.parquet(staged)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(conf)
    system.mkdirs(at.getParent())
    if not system.rename(jvm.org.apache.hadoop.fs.Path(staged), at):
        if not exists(spark, path):
            raise OSError(f"cannot publish {path!r}")
        return False
    return True


def publish_refs(docs: DataFrame, folder: str, name: str, lane: Column, source: Column, key: Column, chars: Column) -> bool:
    """Publish references to documents: lane, source folder, id in it, characters."""
    return publish(docs.select(lane.cast("string").alias("lane"), source.cast("string").alias("source"), key.cast("string").alias("id"),
                               chars.cast("bigint").alias("chars"), F.lit(False).alias("flush")), folder, name)


def publish_flush(spark: SparkSession, folder: str, name: str) -> bool:
    """Ask for the open batches of all lanes that ever had a reference to close."""
    lanes = spark.read.schema(REF).parquet(folder).select("lane").distinct()
    return publish(lanes.select("lane", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("id"),
                                F.lit(None).cast("bigint").alias("chars"), F.lit(True).alias("flush")).coalesce(1), folder, name)


class OpenBatch:
    """The open batch of a lane: (source, id, chars) of its documents."""

    def __init__(self, max_docs: int, max_bytes: float, max_ms: int, stored: tuple | None):
        self.max_docs, self.max_ms = max_docs, max_ms
        self.need = max(int(-(-Fraction(max_bytes) * 2 // 3)), 0)
        self.number, self.opened, refs = stored or (0, 0, "[]")
        self.refs: list = json.loads(refs)
        self.closed: list[tuple] = []

    def stored(self) -> tuple:
        return self.number, self.opened, json.dumps(self.refs)

    def _close(self, refs: list, reason: str) -> None:
        self.closed += [(self.number, reason, *r) for r in refs]
        self.number += 1

    def close_if_old(self, now: int) -> None:
        if self.refs and now - self.opened >= self.max_ms:
            self._close(self.refs, TIME)
            self.refs = []

    def add(self, refs: list, now: int) -> None:
        """Documents in order; the one that fills a batch belongs to it."""
        if not refs:
            return
        if not self.refs:
            self.opened = now
        rows, begin = self.refs + refs, 0
        lengths = np.array([r[2] or 0 for r in rows], np.int64)
        cuts = Cuts(lengths, self.max_docs, self.need)
        while (end := int(cuts.end(begin))) <= cuts.n:
            self._close(rows[begin:end], COUNT if end - begin >= self.max_docs else BYTES)
            begin = end
            if begin == cuts.n:
                break
        if begin and begin < cuts.n:
            self.opened = now
        self.refs = rows[begin:]

    def flush(self) -> None:
        if self.refs:
            self._close(self.refs, FLUSH)
            self.refs = []


def _step(max_docs: int, max_bytes: float, max_ms: int):
    """One call per lane and micro-batch, or per timer."""
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        batch = OpenBatch(max_docs, max_bytes, max_ms, tuple(state.get) if state.exists else None)
        batch.close_if_old(now)
        frames = [] if state.hasTimedOut else list(frames)
        if frames:
            rows = pd.concat(frames, ignore_index=True)
            flush = rows["flush"].to_numpy(bool)
            docs = rows[~flush].sort_values(["source", "id"], kind="stable")
            batch.add([[s, i, 0 if pd.isna(c) else int(c)] for s, i, c in zip(docs["source"], docs["id"], docs["chars"])], now)
            if flush.any():
                batch.flush()
        state.update(batch.stored())
        if batch.refs:
            state.setTimeoutDuration(max(batch.opened + max_ms - now, 1))
        yield pd.DataFrame([(key[0], *c) for c in batch.closed], columns=["lane", "upload_batch_no", "reason", "source", "id", "chars"])
    return run


def start_uploads(spark: SparkSession, refs_dir: str, out_dir: str, checkpoint: str, max_docs: int = 10_000,
                  max_bytes: float = 256 * 1024 * 1024, max_seconds: float = 1800, documents=None,
                  max_files_per_trigger: int | None = None, trigger: str = "1 minute", query_name: str = "uploads"):
    """Start the stream over published references; timers need a processing-time
    ``trigger`` (Spark never ends an ``availableNow`` run that has them).  Every micro-batch writes the
    references of the batches it closed to ``out_dir/closed``; with ``documents`` (a
    function from the source folders named to a frame with ``source`` and ``id``) also their
    documents, one file per batch, to ``out_dir/uploads``."""
    reader = spark.readStream.schema(REF)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    closed = (reader.parquet(refs_dir).groupBy("lane")
              .applyInPandasWithState(_step(max_docs, max_bytes, round(1000 * max_seconds)), CLOSED, STATE, "append",
                                      GroupStateTimeout.ProcessingTimeTimeout))

    def sink(batch: DataFrame, batch_id: int):
        path = f"{out_dir}/closed/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)         # the one pass over the state
        if documents is None:
            return
        refs = spark.read.schema(CLOSED).parquet(path)
        sources = [r["source"] for r in refs.select("source").distinct().collect()]     # folders that arrived in open batches
        docs = documents(sources).join(refs.drop("chars"), ["source", "id"])
        keys = ["lane", "upload_batch_no"]
        (docs.repartition(*keys).sortWithinPartitions(*keys).write.mode("overwrite").partitionBy(*keys)
             .option("compression", "gzip").option("maxRecordsPerFile", 0).parquet(f"{out_dir}/uploads/batch_id={batch_id}"))

    writer = (closed.writeStream.queryName(query_name).outputMode("append")
                    .option("checkpointLocation", checkpoint).foreachBatch(sink))
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return _start(writer, trigger)
    finally:
        spark.conf.set(PROVIDER, before)


def await_taken(query, offset: int, seconds: float = 600) -> None:
    """Wait until a micro-batch has ended that took what was published at ``offset`` (0, 1, ...).
    Where every publication waits for the one before, each is one micro-batch."""
    until = time.monotonic() + seconds
    while True:
        progress = query.lastProgress
        end = json.loads(progress.json)["sources"][0]["endOffset"] if progress else None
        if end and end["logOffset"] >= offset:
            return
        if query.exception() is not None:
            raise query.exception()
        if time.monotonic() > until:
            raise TimeoutError(f"publication {offset} was not taken within {seconds} seconds")
        time.sleep(0.1)


def drain(spark: SparkSession, query, refs_dir: str, out_dir: str, seconds: float = 600) -> None:
    """Wait until every published reference is in a closed batch (after a flush), then stop."""
    until = time.monotonic() + seconds

    def done() -> bool:
        if not exists(spark, f"{out_dir}/closed"):
            return False
        closed = spark.read.schema(f"{CLOSED}, batch_id long").parquet(f"{out_dir}/closed").agg(F.count("id"), F.max("batch_id")).first()
        if closed[0] < spark.read.schema(REF).parquet(refs_dir).where("not flush").count():
            return False
        return closed[1] is None or (query.lastProgress or {"batchId": -1})["batchId"] >= closed[1]     # its sink has ended

    try:
        while not done():
            if query.exception() is not None:
                raise query.exception()
            if time.monotonic() > until:
                raise TimeoutError(f"open batches were not closed within {seconds} seconds")
            time.sleep(0.3)
    finally:
        query.stop()


def read_closed(spark: SparkSession, out_dir: str) -> DataFrame:
    """References of closed batches: lane, upload_batch_no, reason, source, id, chars."""
    return spark.read.schema(CLOSED).parquet(f"{out_dir}/closed")


def batch_summary(closed: DataFrame) -> DataFrame:
    """Per closed batch: documents, estimated bytes and why it closed."""
    return closed.groupBy("lane", "upload_batch_no", "reason").agg(
        F.count(F.lit(1)).cast("bigint").alias("docs"), F.sum(F.col("chars") * F.lit(1.5)).cast("double").alias("est_bytes"))
