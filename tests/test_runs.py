"""Run state across stages: claims, audits, resets, commit streams, upload files."""

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from crawlsieve.files import claim
from crawlsieve.plans import jobs, run_queries, runs
from crawlsieve.plans.registry import QUERIES
from crawlsieve.session import scratch_path
from crawlsieve.sources import sinks


def test_two_runs_that_end_together_get_different_numbers(spark, monkeypatch):
    root = scratch_path(spark, "runs")
    a, b = runs.RunStore(spark, root, "a"), runs.RunStore(spark, root, "b")
    nothing = a.commits()
    with monkeypatch.context() as m:
        m.setattr(runs.RunStore, "commits", lambda self: nothing)      # neither sees the other's commit
        assert [a.commit(), b.commit()] == [1, 2]
    assert {(r.run_id, r.seq) for r in a.commits().collect()} == {("a", 1), ("b", 2)}


def test_a_claim_has_one_owner(spark):
    path = scratch_path(spark, "claim")
    assert claim(spark, path, "a") and not claim(spark, path, "b")


def test_audit_survives_a_failed_sink(spark):
    root = scratch_path(spark, "runs")
    store = runs.RunStore(spark, root, "r")
    df = spark.range(7)
    with pytest.raises(ZeroDivisionError):
        store.audited("out", df, lambda d: 1 / 0)
    assert store.audited("out", df, lambda d: d.write.mode("overwrite").parquet(store.path("out"))) == 7
    assert store.audited("void", df.where("id < 0"), lambda d: d.repartition("id").write.mode("overwrite").parquet(store.path("void"))) == 0
    store._note("killed", "x", "attempt")
    got = {r.sink: r.asDict() for r in runs.sink_outcomes(spark, root).collect()}
    assert got["out"] == {"run_id": "r", "sink": "out", "attempts": 2, "ok": 1, "failed": 1, "rows": 7, "lost": 0, "retries": 1}
    assert (got["killed"]["lost"], got["void"]["rows"]) == (1, 0)
    assert runs.sink_outcomes(spark, scratch_path(spark, "none")).collect() == []


def test_no_upload_file_exceeds_a_threshold_by_more_than_a_document(spark):
    root, warc_root = run_queries._crawl_with_archives(spark, SF001)
    out, target = scratch_path(spark, "b"), scratch_path(spark, "w")
    run_queries._batcher(spark, root, out)
    for i, (docs, size, lanes) in enumerate(((3, 1e9, None), (1000, 6000, None), (4, 9000, 2))):
        jobs.run_worker(spark, f"{out}/batches", "{base}/{file}", warc_root, f"{target}{i}", None, max_docs=docs, max_bytes=size, lanes=lanes)
        rows = sinks.read_documents(spark, f"{target}{i}", runs=True)
        files = (rows.withColumn("f", F.input_file_name()).groupBy("f")
                 .agg(F.count("*").alias("n"), F.sum(F.col("char_count") * 1.5).alias("size"),
                      F.max(F.col("char_count") * 1.5).alias("largest"), F.count_distinct("day").alias("days")))
        assert files.where(f"n > {docs} or size - largest >= {size} or days > 1").count() == 0
        assert files.count() > 1 and rows.count() == 17


def test_reset_hides_documents_at_once(spark):
    root, warc_root = run_queries._crawl_with_archives(spark, SF001)
    out, target = scratch_path(spark, "b"), scratch_path(spark, "w")
    run_queries._batcher(spark, root, out)
    jobs.run_worker(spark, f"{out}/batches", "{base}/{file}", warc_root, target, None)
    before = {r.crawl: r["count"] for r in jobs.worker_documents(spark, target).groupBy("crawl").count().collect()}
    jobs.reset_crawls(spark, out, run_queries.CRAWLS[1:])
    after = {r.crawl: r["count"] for r in jobs.worker_documents(spark, target).groupBy("crawl").count().collect()}
    assert len(before) == 2 and after == {run_queries.CRAWLS[0]: before[run_queries.CRAWLS[0]]}
    with pytest.raises(ValueError):     # documents of other batches
        other = scratch_path(spark, "b")
        run_queries._batcher(spark, root, other)
        jobs.run_worker(spark, f"{other}/batches", "{base}/{file}", warc_root, target, None)


def test_stream_never_reads_an_uncommitted_run(spark):
    assert QUERIES["worker_stream_commits"](spark, SF001).groupBy("url").count().where("count > 1").count() == 0


def test_folders_of_uploads_are_named_and_read_as_sparks_own(spark):
    rows = [("a", "1", "20240714000000", "plain", 0), ("b", "2", "20240715000000", "sp ace+%41'é/=:[x]", 1),
            ("c", "3", "unknown", None, 2), ("d", "4", "", "", 2), ("e", None, "20240714000000", "plain", 0)]
    df = sinks.with_date_parts(spark.createDataFrame(rows, "url string, full_text string, timestamp string, crawl string, upload_batch_no long")
                               .withColumn("source_run", F.lit("r1")))
    ours, theirs = scratch_path(spark, "ours"), scratch_path(spark, "theirs")
    sinks.write_uploads(df, f"{ours}/run_id=r", above=sinks.ORIGIN, mode="overwrite")
    keys = [*sinks.ORIGIN, *sinks.DATE_PARTS, "upload_batch_no"]
    df.write.partitionBy(*keys).option("compression", "gzip").parquet(f"{theirs}/run_id=r")

    def folders(root):
        return sorted({str(p.parent.relative_to(root)) for p in Path(root).rglob("*.parquet")})

    assert folders(ours) == folders(theirs)
    columns = ["url", "full_text", "timestamp", "run_id", *keys]
    expect = [tuple(r) for r in spark.read.schema("url string, full_text string, timestamp string, run_id string, source_run string, crawl string, "
                                                  "year string, month string, day string, upload_batch_no int").parquet(theirs).orderBy("url").collect()]
    for root in (ours, theirs):
        got = sinks.read_documents(spark, root, runs=True)
        assert [tuple(r) for r in got.select(columns).orderBy("url").collect()] == expect
    assert sinks.read_documents(spark, ours, runs=True, only=["r", "lost"]).count() == 5
    assert sinks.read_documents(spark, ours, runs=True, only=[]).count() == 0
    # once more: replaced, not added to; then added to
    sinks.write_uploads(df.where("url = 'a'"), f"{ours}/run_id=r", above=sinks.ORIGIN, mode="overwrite")
    sinks.write_uploads(df.where("url = 'a'"), f"{ours}/run_id=r", above=sinks.ORIGIN)
    assert [r.url for r in sinks.read_documents(spark, ours).collect()] == ["a", "a"]
    sinks.write_uploads(df.where("url = ''"), f"{ours}/run_id=r", above=sinks.ORIGIN, mode="overwrite")
    assert sinks.read_documents(spark, ours, runs=True).count() == 0


def test_small_uploads_cost_neither_processes_nor_discovery(spark):
    df = sinks.with_date_parts(spark.range(40).select(F.col("id").cast("string").alias("url"), F.lit("20240714000000").alias("timestamp"),
                                                      F.lit("t").alias("full_text"), F.lit("r1").alias("source_run"), F.lit("c").alias("crawl"),
                                                      F.floor(F.col("id") / 2).alias("upload_batch_no")))
    out = scratch_path(spark, "uploads")
    sinks.write_uploads(df, f"{out}/run_id=r", above=sinks.ORIGIN, mode="overwrite")
    names = [p.name for p in Path(out).rglob("*") if p.is_file() and p.name != "_SUCCESS" and p.name != "._SUCCESS.crc"]
    # Spark's writer leaves a checksum beside each file, and starts two processes for its rights
    assert len(names) == 20 and all(n.endswith(".gz.parquet") and not n.startswith(".") for n in names)
    docs = sinks.read_documents(spark, out, runs=True)
    relation = [line for line in docs._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Relation" in line]
    assert len(relation) == 1 and "run_id" not in relation[0] and "upload_batch_no" not in relation[0]
    assert sorted(r["count"] for r in docs.groupBy("upload_batch_no").count().collect()) == [2] * 20


def test_a_failed_upload_leaves_no_file(spark):
    path = f"{scratch_path(spark, 'uploads')}/run_id=r"
    df = sinks.with_date_parts(spark.range(40).select(F.col("id").cast("string").alias("url"), F.lit("20240714000000").alias("timestamp"),
                                                      F.when(F.col("id") < 39, F.lit("t")).otherwise(F.raise_error(F.lit("bad row"))).alias("full_text"),
                                                      F.col("id").alias("upload_batch_no")))
    with pytest.raises(Exception, match="bad row"):
        sinks.write_uploads(df, path, mode="overwrite")
    assert not list(Path(path).rglob("*.parquet"))
    with pytest.raises(ValueError):
        sinks.write_uploads(df, path, mode="ignore")


def test_a_file_of_several_row_groups_is_whole(spark, monkeypatch):
    monkeypatch.setattr(sinks, "ROW_GROUP_BYTES", 100)
    out = scratch_path(spark, "big")
    pieces = [pa.RecordBatch.from_pydict({"url": [f"{b}-{i}" for i in range(9)], "day": ["1"] * 5 + ["2"] * 4}) for b in range(1)]
    pieces += [pa.RecordBatch.from_pydict({"url": [f"{b}-{i}" for i in range(9)], "day": ["2"] * 9}) for b in range(1, 6)]
    assert list(sinks._to_files(f"file:{out}", ["day"], "x.parquet")(iter(pieces))) == []
    files = {day: pq.ParquetFile(f"{out}/day={day}/x.parquet") for day in "12"}
    assert files["1"].metadata.num_rows == 5 and files["2"].metadata.num_rows == 49 and files["2"].metadata.num_row_groups > 1
    assert [u.as_py() for u in files["2"].read().column("url")] == [f"0-{i}" for i in range(5, 9)] + [f"{b}-{i}" for b in range(1, 6) for i in range(9)]
