"""Run folders and commits: what makes a stage safe to run twice.

Every run writes its tables to ``<root>/<table>/run_id=<id>`` with overwrite
and ends with one commit row.  Readers take only committed runs, so a run that
died half-way is invisible and can be repeated under its id.  Commits carry a
monotone sequence number; "later" always means that number, never a clock or a
name.  A reset is a commit of its own: rows of a crawl from before its latest
reset no longer count.

Sinks are audited (A10): `audited` notes every try of a sink before and after it
in the ``outcomes`` table, which counts whether or not the run commits.
"""

from __future__ import annotations

import re
import uuid

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crawlsieve.files import claim, exists

COMMIT = "seq long, kind string, at timestamp"
OUTCOME = "sink string, attempt string, status string, rows long, error string, at timestamp"


class RunStore:
    """The tables below ``root`` and the run that is writing them."""

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.run_id = run_id or f"run-{uuid.uuid4().hex}"
        if not re.fullmatch(r"[A-Za-z][\w-]*", self.run_id):
            raise ValueError(f"run id must be a word that starts with a letter: {self.run_id!r}")

    def path(self, table: str) -> str:
        """This run's folder of a table."""
        return f"{self.root}/{table}/run_id={self.run_id}"

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Write this run's rows (replacing those of a failed attempt); read them back."""
        df.write.mode("overwrite").parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def commits(self) -> DataFrame:
        """(run_id, seq, kind, at), one row per committed run."""
        if not exists(self.spark, f"{self.root}/commits"):
            return self.spark.createDataFrame([], f"run_id string, {COMMIT}")
        return self.spark.read.schema(f"{COMMIT}, run_id string").parquet(f"{self.root}/commits")

    def committed(self, df: DataFrame) -> DataFrame:
        """Rows of committed runs, with ``seq``.  The ids (one per run) are also a
        partition filter, so folders of other runs are not opened."""
        done = self.commits().select("run_id", "seq")
        ids = [r["run_id"] for r in done.collect()]
        return df.where(F.col("run_id").isin(ids)).join(done, "run_id")

    def rows(self, table: str, schema: str) -> DataFrame:
        """Committed rows of a table with ``run_id`` and ``seq``; none if it was never written."""
        if not exists(self.spark, f"{self.root}/{table}"):
            return self.spark.createDataFrame([], f"{schema}, run_id string, seq long")
        df = self.spark.read.schema(f"{schema}, run_id string").parquet(f"{self.root}/{table}")
        return self.committed(df)

    def commit(self, kind: str = "run") -> int:
        """Make this run visible; returns its sequence number."""
        done = self.commits()
        if done.where(F.col("run_id") == self.run_id).limit(1).count():
            raise ValueError(f"run {self.run_id!r} is already committed")
        seq = (done.agg(F.max("seq")).first()[0] or 0) + 1
        while not claim(self.spark, f"{self.root}/claims/{seq}", self.run_id):   # taken by a run that ends just now
            seq += 1
        (self.spark.range(1).select(F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"),
                                    F.current_timestamp().alias("at"))
             .write.mode("overwrite").parquet(self.path("commits")))
        return seq

    def _note(self, sink: str, attempt: str, status: str, rows: int | None = None, error: str | None = None) -> None:
        (self.spark.createDataFrame([(sink, attempt, status, rows, error)], "sink string, attempt string, status string, rows long, error string")
             .withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path("outcomes")))

    def audited(self, sink: str, df: DataFrame, write: Callable[[DataFrame], None]) -> int:
        """Run ``write(df)`` between two notes; returns the rows written.  A try that
        was killed leaves only the first note."""
        attempt = uuid.uuid4().hex
        self._note(sink, attempt, "attempt")
        seen = Observation(f"{sink}_{attempt}")
        try:
            write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        except Exception as e:
            self._note(sink, attempt, "failed", error=type(e).__name__)
            raise
        rows = observed_rows(seen)
        self._note(sink, attempt, "ok", rows)
        return rows


def observed_rows(seen: Observation) -> int:
    """The count `rows` of a finished write.  Where adaptive execution found a stage empty
    and cut the rest of the plan, nothing is reported: no row was written."""
    try:
        return int(seen.get["rows"])
    except Py4JJavaError as e:
        if "AssertionError" not in str(e):
            raise
        return 0


def sink_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """A10: per run and sink: tries, retries, how they ended, and the rows written.
    ``lost`` tries have no second note (killed, or still at work)."""
    path = f"{root.rstrip('/')}/outcomes"
    notes = (spark.read.schema(f"{OUTCOME}, run_id string").parquet(path) if exists(spark, path)
             else spark.createDataFrame([], f"{OUTCOME}, run_id string"))

    def n(status: str):
        return F.count_if(F.col("status") == status).cast("bigint")

    return (notes.groupBy("run_id", "sink").agg(
        n("attempt").alias("attempts"), n("ok").alias("ok"), n("failed").alias("failed"),
        F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("rows"))), F.lit(0)).cast("bigint").alias("rows"))
        .withColumn("lost", F.col("attempts") - F.col("ok") - F.col("failed"))
        .withColumn("retries", F.greatest(F.col("attempts") - 1, F.lit(0)).cast("bigint")))


def since_reset(df: DataFrame, resets: DataFrame) -> DataFrame:
    """Rows (crawl, seq) that are newer than the latest reset (crawl, reset_seq) of their crawl."""
    return (df.join(resets, "crawl", "left")
              .where(F.col("reset_seq").isNull() | (F.col("seq") > F.col("reset_seq"))).drop("reset_seq"))
