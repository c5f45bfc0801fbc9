"""Keyed stream state, upload batches in a stream, ranges by bytes, late payloads, parallel thresholds."""

import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from crawlsieve.operators import batching, dedup, extract
from crawlsieve.plans import fixtures, index_stage
from crawlsieve.session import scratch_path
from crawlsieve.sources import ranged, ranges
from crawlsieve.streaming import uploads, worker

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


# --- T5 ------------------------------------------------------------------------

def test_seen_state_costs_the_same_for_every_arrival(spark):
    lines = scratch_path(spark, "lines")
    n, arrivals = 400, 7
    for a in range(arrivals):       # half of each arrival is new, half was in the first one
        rows = spark.range(n).select(
            F.lit("c").alias("crawl"), F.lit(a).alias("crawl_rank"), F.lit(a).alias("block_id"), F.col("id").cast("int").alias("line_no"),
            F.concat(F.lit("u"), F.when(F.col("id") < n // 2, F.col("id")).otherwise(F.col("id") + a * n), F.lit(")/")).alias("surt_url"),
            F.lit("20240101").alias("timestamp"))
        rows.coalesce(1).write.mode("append").parquet(lines)
    out, seen, ckpt = (scratch_path(spark, x) for x in "osc")
    q = worker.start_index_dedup(spark, lines, out, seen, ckpt, lambda df: df, max_files_per_trigger=1)
    assert q.awaitTermination(300)
    progress = [p for p in q.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [n] * arrivals
    ops = [p["stateOperators"][0] for p in progress]
    assert ops[-1]["numRowsTotal"] > 3 * ops[0]["numRowsTotal"]             # the history grows,
    reads = [o["customMetrics"]["rocksdbGetCount"] for o in ops]
    assert max(reads[1:]) <= min(reads[1:]) * 1.1 <= 3 * n                  # what an arrival looks up does not
    kept = spark.read.parquet(out)
    assert kept.count() == n + (arrivals - 1) * n // 2
    assert kept.where("block_id > 0 and line_no < 200").count() == 0
    assert spark.read.parquet(seen).count() == kept.count()


# --- T3 ------------------------------------------------------------------------

def _refs(spark, folder, name, rows):
    df = spark.createDataFrame(rows, "lane string, id string, chars long").coalesce(1)
    return uploads.publish_refs(df, folder, name, F.col("lane"), F.lit("s"), F.col("id"), F.col("chars"))


def test_open_batch_rules():
    b = uploads.OpenBatch(3, 30, 1000, None)
    b.add([["s", "a", 5], ["s", "b", 5]], 100)
    assert not b.closed and b.opened == 100
    b = uploads.OpenBatch(3, 30, 1000, b.stored())
    b.add([["s", "c", 1], ["s", "d", 30], ["s", "e", 1]], 500)
    assert [(n, r, i) for n, r, _, i, _ in b.closed] == [(0, "count", "a"), (0, "count", "b"), (0, "count", "c"), (1, "bytes", "d")]
    assert (b.number, b.opened, len(b.refs)) == (2, 500, 1)
    b.close_if_old(1499)
    assert len(b.closed) == 4
    b.close_if_old(1500)
    assert b.closed[-1][:2] == (2, "time") and not b.refs
    b.flush()
    assert len(b.closed) == 5


def test_timer_closes_batches_and_files_are_batches(spark):
    folder, out = scratch_path(spark, "refs"), scratch_path(spark, "up")
    rng = random.Random(1)
    rows = [(f"l{i % 3}", f"{i:05d}", rng.randrange(1, 40)) for i in range(100)]
    docs = spark.createDataFrame([("s", i, "x" * c) for _, i, c in rows], "source string, id string, full_text string")
    assert _refs(spark, folder, "0", rows[:60]) and not _refs(spark, folder, "0", rows)     # a replay publishes nothing
    q = uploads.start_uploads(spark, folder, out, scratch_path(spark, "c"), max_docs=7, max_bytes=200, max_seconds=3,
                              trigger="500 milliseconds", documents=lambda sources: docs.where(F.col("source").isin(sources)))
    try:
        time.sleep(4)
        _refs(spark, folder, "1", rows[60:])
    finally:
        uploads.drain(spark, q, folder, out, 90)
    closed = uploads.read_closed(spark, out)
    assert closed.count() == closed.select("id").distinct().count() == 100
    for r in uploads.batch_summary(closed).collect():
        assert {"count": r.docs == 7, "bytes": r.est_bytes >= 200 and r.docs < 7, "time": r.est_bytes < 200 and r.docs < 7}[r.reason], r
    assert closed.where("reason = 'time'").count() > 0
    files = (spark.read.parquet(f"{out}/uploads").withColumn("f", F.input_file_name()).groupBy("lane", "upload_batch_no")
             .agg(F.count_distinct("f").alias("files"), F.count("*").alias("n")))
    assert files.where("files > 1").count() == 0 and files.agg(F.sum("n")).first()[0] == 100


def test_arrivals_of_many_files_are_one_micro_batch_each(spark, monkeypatch):
    """worker_stream_batches: many tasks read and publish an arrival; batches are those of its order."""
    from crawlsieve.plans import run_queries
    tasks, arrivals, publish = [], [], uploads.publish_refs
    rng = random.Random(8)
    rows = [(i, i % 4, rng.randrange(500, 9000)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, lane long, n int").select("doc_id", "lane", F.expr("repeat('x', n)").alias("text"))
    monkeypatch.setattr(run_queries, "_lanes", lambda *a: docs.repartition(6))

    def publish_refs(df, folder, name, *a):
        tasks.append(df.rdd.getNumPartitions())
        arrivals.append(df.count())
        return publish(df, folder, name, *a)

    monkeypatch.setattr(uploads, "publish_refs", publish_refs)
    opened = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))       # a task for each file
    try:
        got = run_queries.q_worker_stream_batches(spark, SF001).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", opened)
    assert arrivals == [120] * 5 and min(tasks) > 1
    want = []
    for lane in range(4):
        sizes = [n for _, of, n in rows if of == lane]
        b = uploads.OpenBatch(10, 40000, 1 << 60, None)
        b.add([["documents", str(i), n] for i, n in enumerate(sizes)], 0)
        b.flush()
        for number in range(b.number):
            of = [c for c in b.closed if c[0] == number]
            want.append((lane, number, of[0][1], len(of), sum(c[4] for c in of) * 1.5))
    assert sorted(map(tuple, got)) == sorted(want)


def test_worker_stream_feeds_upload_batches(spark):
    from crawlsieve.plans.registry import _batches_with_archive_ranges
    batches_dir, warc_root = _batches_with_archive_ranges(spark, SF001)
    out, up = scratch_path(spark, "wo"), scratch_path(spark, "up")
    worker.start_worker(spark, batches_dir, out, scratch_path(spark, "wc"), fixtures.WARC_TEMPLATE, warc_root, None, upload_lanes=2).awaitTermination()
    refs = f"{out}_state/refs"
    uploads.publish_flush(spark, refs, "flush")
    q = uploads.start_uploads(spark, refs, up, scratch_path(spark, "c"), max_docs=4, max_bytes=1e9, trigger="200 milliseconds",
                              documents=worker.documents_of_batches(spark, out))
    uploads.drain(spark, q, refs, up, 120)
    docs, files = worker.read_worker_output(spark, out), spark.read.parquet(f"{up}/uploads")
    assert files.count() == docs.count() == files.select("url").distinct().count() > 8
    assert files.groupBy(F.input_file_name()).count().where("count > 4").count() == 0


# --- S3, S5 ----------------------------------------------------------------------

def test_tasks_read_near_equal_bytes_and_requests_merge(spark):
    rng = random.Random(2)
    rows = []
    for f in range(40):             # one file holds a third of all bytes
        at = 0
        for _ in range(600 if f == 0 else 30):
            n = rng.randrange(1_000, 60_000)
            rows.append((f"file-{f}", at, n))
            at += n + (rng.choice([0, 0, 0, 500_000]))
    m = spark.createDataFrame(rows, "path string, offset long, length long").repartition(5)
    plan = ranges.plan_ranges(m, "path", "offset", "length", 16, most=1 << 20)
    got = plan.groupBy("_task").agg(F.sum("length").alias("bytes")).collect()
    total = sum(n for _, _, n in rows)
    assert len(got) == 16 and all(abs(r["bytes"] - total / 16) < 2.2e6 for r in got)
    per_request = plan.groupBy("path", "_request").agg(F.count("*").alias("n"), F.count_distinct("_task").alias("tasks"),
                                                       (F.max(F.col("offset") + F.col("length")) - F.min("offset")).alias("span"),
                                                       F.sum("length").alias("bytes"))
    assert per_request.where("tasks > 1 or span > bytes + 65536 * n or span > 2 * 1048576").count() == 0
    assert per_request.count() < len(rows) / 3
    placed = plan.repartitionById(16, F.col("_task")).withColumn("p", F.spark_partition_id())
    assert placed.where("p <> _task").count() == 0


class Reader:
    def __init__(self, data):
        self.data, self.reads = data, []

    def read(self, path, offset, length):
        self.reads.append((path, offset, length))
        if offset + length > len(self.data):
            raise EOFError("short read")
        return self.data[offset:offset + length]

    def close(self):
        pass


def test_one_read_for_a_request_and_single_errors():
    import pyarrow as pa
    rows = [("a", 0, 0, 10), ("a", 0, 10, 5), ("a", 0, 20, 5), ("b", 7, 0, 5), ("b", 7, 5, 999), ("b", 7, 5, None), ("b", 9, 50, 5)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("p", "_request", "o", "l"), r)) for r in rows])
    reader = Reader(bytes(range(100)))
    got = [(r["p"], data, type(e).__name__) for r, data, e in ranges.fetched([batch], reader, "p", "o", "l")]
    assert reader.reads[0] == ("a", 0, 25) and len(reader.reads) == 4
    assert [g[1] for g in got] == [bytes(range(10)), bytes(range(10, 15)), bytes(range(20, 25)), bytes(range(5)), None, None, bytes(range(50, 55))]
    assert [g[2] for g in got][4:6] == ["EOFError", "TypeError"]


def test_merged_ranges_read_the_same_records(spark, monkeypatch):
    from crawlsieve.plans.registry import QUERIES
    merged = sorted(map(str, QUERIES["warc_record_scan"](spark, SF001).collect()))
    monkeypatch.setattr(ranged, "_plan_ranges", lambda m, path, offset, length, n: m.withColumn("_request", F.monotonically_increasing_id())
                        .repartitionByRange(n or 4, path, offset).sortWithinPartitions(path, offset))
    assert merged == sorted(map(str, QUERIES["warc_record_scan"](spark, SF001).collect()))


# --- D1, D4 ------------------------------------------------------------------------

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_hash_aggregates_narrow_rows(spark):
    passed = index_stage.kept_entries(fixtures.cdx_from_dir(spark, SF001), dedup=False)
    for df in (dedup.dedup_first_seen(passed), dedup.dedup_latest(passed)):
        plan = _plan(df)
        assert "SortAggregate" not in plan and "HashAggregate" in plan
        assert "metadata" not in plan.split("HashAggregate")[1].split("\n")[0]


def test_positions_keep_their_order_and_overflow_raises(spark):
    rows = [(0, -2 ** 63, 0), (0, -5, 3), (0, 0, 0), (0, 0, 1), (0, 2 ** 63 - 1, 10 ** 9), (1, -2 ** 63, 0), (99_999_999, 2 ** 63 - 1, 5)]
    df = spark.createDataFrame(rows, "crawl_rank int, block_id long, line_no int")
    got = [r["p"] for r in df.select(dedup.position().alias("p"), "*").orderBy("crawl_rank", "block_id", "line_no").collect()]
    assert got == sorted(got) and len(set(got)) == len(rows)
    with pytest.raises(Exception, match="out of range"):
        spark.createDataFrame([(-1, 0, 0)], "crawl_rank int, block_id long, line_no int").select(dedup.position()).collect()


def test_a_block_named_twice_gives_one_row(spark):
    passed = index_stage.kept_entries(fixtures.cdx_from_dir(spark, SF001), dedup=False)
    twice = passed.unionByName(passed)
    for fn in (dedup.dedup_first_seen, dedup.dedup_latest):
        key = ["crawl", "block_id", "line_no"]
        assert sorted(map(tuple, fn(twice).select(*key).collect())) == sorted(map(tuple, fn(passed).select(*key).collect()))


# --- B3 ------------------------------------------------------------------------

@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([None, "a", "a", "b"]), st.integers(0, 9)), min_size=1, max_size=150),
       st.integers(1, 6), st.sampled_from([0, 3, 14, 10 ** 9]), st.integers(1, 9))
def test_threshold_batches_by_composition(spark, docs, max_docs, max_bytes, block_rows):
    df = spark.createDataFrame([(i, lane, "x" * n) for i, (lane, n) in enumerate(docs)], "doc_id long, lane string, text string").repartition(3)
    got = {r.doc_id: r.upload_batch_no for r in batching.batch_threshold(
        df, "lane", ("doc_id",), "text", max_docs=max_docs, max_bytes=max_bytes, block_rows=block_rows, fan=2).collect()}
    expect, state = {}, {}
    for i, (lane, n) in enumerate(docs):
        d, s, b = state.get(lane, (0, 0.0, 0))
        expect[i] = b
        d, s = d + 1, s + n * 1.5
        if d >= max_docs or s >= max_bytes:
            d, s, b = 0, 0.0, b + 1
        state[lane] = (d, s, b)
    assert got == expect


def test_one_lane_is_many_tasks_and_texts_stay_out_of_python(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(1).alias("lane"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    out = batching.batch_threshold(df, "lane", ("doc_id",), "text", max_docs=20, max_bytes=900, block_rows=100)
    for line in _plan(out).split("\n"):
        assert "MapInArrow" not in line or "text" not in line
    sizes = out.groupBy("upload_batch_no").agg(F.count("*").alias("n"), F.sum(F.length("text") * 1.5).alias("s"), F.max(F.length("text") * 1.5).alias("m"))
    assert out.count() == 4000 and sizes.where("n > 20 or s - m >= 900").count() == 0
    assert sizes.count() > 200


# --- P7 ------------------------------------------------------------------------

def test_blocks_shared_by_pages_leave_all_of_them(spark):
    shared, twice = "s" * 40, "t" * 40
    rows = [(1, f"own one\n{shared}\nlast"), (2, f"{shared}\n{twice}"), (3, shared), (4, f"{twice}\nown four\n{twice}"), (5, None), (6, ""), (7, "short"),
            (8, "short"), (9, "short")]
    df = spark.createDataFrame(rows, "page_id int, text string")
    got = {r.page_id: r.text for r in extract.drop_repeated_blocks(df, least_chars=10, most_pages=2).collect()}
    assert got == {1: "own one\nlast", 2: twice, 3: None, 4: f"{twice}\nown four\n{twice}", 5: None, 6: "", 7: "short", 8: "short", 9: "short"}
