"""Stage jobs: resume from the ledger, incremental dedup with a bucketed
seen table, funnel observation."""

from pyspark.sql import functions as F

from conftest import SF001
from crawlsieve.operators import dedup, metrics
from crawlsieve.plans import fixtures, index_stage, jobs
from crawlsieve.sources import sinks
from crawlsieve.session import scratch_path


def _kept_keys(spark, paths):
    return {r.surt_url for r in spark.read.parquet(paths["kept"]).select("surt_url").collect()}


def test_batcher_rerun_resumes_and_skips_seen(spark):
    root = scratch_path(spark, "blocks")
    fixtures.write_blocks(fixtures.cdx_from_dir(spark, SF001), root)
    out = scratch_path(spark, "batcher")
    args = (spark, list(fixtures.CRAWLS), fixtures.INDEX_TEMPLATE, fixtures.BLOCK_TEMPLATE, root, out)
    p1 = jobs.run_batcher(*args, max_blocks=1, run_id="r1")
    first = _kept_keys(spark, p1)
    p2 = jobs.run_batcher(*args, run_id="r2")           # block 1 is done: only the rest is fetched
    second = _kept_keys(spark, p2)
    assert first and second and not (first & second)
    led = spark.read.parquet(p2["ledger"])
    assert led.where("run_id = 'r2' AND block_id = 1").count() == 0
    # together the two runs keep exactly the first-seen winners
    expect = {r.surt_url for r in dedup.dedup_first_seen(
        index_stage.kept_entries(fixtures.cdx_from_dir(spark, SF001), dedup=False)).collect()}
    assert first | second == expect
    for p, keys in ((p1, first), (p2, second)):
        f = spark.read.parquet(p["funnel"])
        assert f.groupBy().sum("kept").first()[0] == len(keys)
        assert f.where("total <> parse_error + language + status + duplicate + kept").count() == 0
    assert {r.status for r in jobs.crawl_status(spark, out).collect()} == {"completed"}
    counts = {r.crawl: r.batches for r in metrics.batch_counts(jobs.published_batches(spark, out)).collect()}
    assert sum(counts.values()) == sinks.read_batches(spark, p2["batches"]).count()


def test_bucketed_seen_table(spark):
    root = scratch_path(spark, "blocks")
    fixtures.write_blocks(fixtures.cdx_from_dir(spark, SF001), root)
    out = scratch_path(spark, "batcher")
    name = "seen_" + out.rsplit("-", 1)[-1]
    args = (spark, list(fixtures.CRAWLS), fixtures.INDEX_TEMPLATE, fixtures.BLOCK_TEMPLATE, root, out)
    p1 = jobs.run_batcher(*args, run_id="r1", seen_table=name, seen_buckets=4)
    assert spark.table(name).count() == 20
    # after a reset the first crawl's keys are free again, the second one's stay taken
    jobs.reset_crawls(spark, out, list(fixtures.CRAWLS)[:1])
    p2 = jobs.run_batcher(*args, run_id="r2", seen_table=name, seen_buckets=4)
    again = spark.read.parquet(p2["kept"]).groupBy("crawl").count().collect()
    assert {r["crawl"]: r["count"] for r in again} == {fixtures.CRAWLS[0]: 17}
    plan = dedup.dedup_incremental(spark.read.parquet(p1["kept"]), dedup.read_seen(spark, name))
    assert plan.count() == 0


def test_observe_funnel(spark):
    parsed = index_stage.parsed_lines(fixtures.cdx_from_dir(spark, SF001))
    df, obs = metrics.observe_funnel(parsed)
    df.write.format("noop").mode("overwrite").save()
    got = obs.get
    assert got["total"] == 67 and got["parse_error"] == 3 and got["pass"] == 23


def test_worker_job_text_modes(spark):
    from crawlsieve.plans.registry import _batches_with_archive_ranges
    batches_dir, warc_root = _batches_with_archive_ranges(spark, SF001)
    m = {}
    flat = sinks.read_documents(spark, jobs.run_worker(spark, batches_dir, fixtures.WARC_TEMPLATE, warc_root,
                                                       scratch_path(spark, "w"), None, metrics_out=m))
    assert m["documents_written"] == flat.count()
    assert m["records_total"] == 3 * m["ranges_fetched"] and m["download_errors"] == 0
    main = spark.read.parquet(jobs.run_worker(spark, batches_dir, fixtures.WARC_TEMPLATE, warc_root,
                                              scratch_path(spark, "w"), None, text_mode="strict"))
    assert flat.count() > 0 and main.count() > 0
    assert main.where(F.col("full_text").contains("<")).count() == 0
    assert "upload_batch_no" in main.columns


def test_completed_crawls_are_skipped(spark):
    root = scratch_path(spark, "blocks")
    fixtures.write_blocks(fixtures.cdx_from_dir(spark, SF001), root)
    out = scratch_path(spark, "batcher")
    args = (spark, list(fixtures.CRAWLS), fixtures.INDEX_TEMPLATE, fixtures.BLOCK_TEMPLATE, root, out)
    live = {}
    jobs.run_batcher(*args, run_id="r1", metrics_out=live)
    assert live["total"] == 67 and live["pass"] == 23 and live["fetch_error"] == 0
    status = jobs.crawl_status(spark, out)
    assert {r.status for r in status.collect()} == {"completed"}
    p2 = jobs.run_batcher(*args, run_id="r2")
    assert spark.read.parquet(p2["parsed"]).count() == 0


def test_a_run_without_commit_does_not_count(spark):
    root = scratch_path(spark, "blocks")
    fixtures.write_blocks(fixtures.cdx_from_dir(spark, SF001), root)
    out = scratch_path(spark, "batcher")
    args = (spark, list(fixtures.CRAWLS), fixtures.INDEX_TEMPLATE, fixtures.BLOCK_TEMPLATE, root, out)
    import pytest
    from crawlsieve.plans import runs
    with pytest.MonkeyPatch.context() as m:
        m.setattr(runs.RunStore, "commit", lambda self, kind="run": 1 / 0)   # dies at the very end
        with pytest.raises(ZeroDivisionError):
            jobs.run_batcher(*args, run_id="r1")
    jobs.run_batcher(*args, run_id="r1")                                     # the same id, again
    assert metrics.batch_counts(jobs.published_batches(spark, out)).groupBy().sum("batches").first()[0] == 2
    with pytest.raises(ValueError):
        runs.RunStore(spark, out, "r1").commit()


def test_blocks_without_lines_become_done(spark):
    import gzip
    root = scratch_path(spark, "blocks")
    fixtures.write_blocks(fixtures.cdx_from_dir(spark, SF001), root)
    index = fixtures.INDEX_TEMPLATE.format(base=root, crawl=fixtures.CRAWLS[0])
    rows = [r.value for r in spark.read.text(index).collect()]
    from pyarrow import fs
    local = fs.LocalFileSystem()
    empty = gzip.compress(b"\n\n")
    with local.open_output_stream(fixtures.BLOCK_TEMPLATE.format(base=root, crawl=fixtures.CRAWLS[0], file="void.gz"), compression=None) as f:
        f.write(empty)
    extra = f"{root}/extra/{fixtures.CRAWLS[0]}"
    local.create_dir(extra, recursive=True)
    with local.open_output_stream(f"{extra}/cluster.idx") as f:
        f.write(("\n".join([*rows, f"zz 2024\tvoid.gz\t0\t{len(empty)}\t99"]) + "\n").encode())
    out = scratch_path(spark, "batcher")
    jobs.run_batcher(spark, [fixtures.CRAWLS[0]], "{base}/extra/{crawl}/cluster.idx", fixtures.BLOCK_TEMPLATE, root, out)
    assert spark.read.parquet(f"{out}/ledger").where("error is not null").select("block_id", "error").collect() == []
    assert [r.status for r in jobs.crawl_status(spark, out).collect()] == ["completed"]


def test_crawl_version_warning():
    import warnings
    from crawlsieve.functions.cdx import parse_crawl_versions
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert parse_crawl_versions(" CC-MAIN-2024-33,bad,, CC-MAIN-2024-33") == ["CC-MAIN-2024-33"]
    assert any("bad" in str(x.message) for x in w)


def test_parquet_batches_table_round_trip(spark):
    from crawlsieve.operators import batching
    from crawlsieve.sources import index as ixsrc
    kept = index_stage.kept_entries(fixtures.cdx_from_dir(spark, SF001))
    msgs = batching.batch_messages(batching.batch_fixed_size(kept, 7))
    path = scratch_path(spark, "batches_pq")
    sinks.write_batches(msgs, path, mode="overwrite", fmt="parquet")
    back = ixsrc.explode_batch_messages(sinks.read_batches(spark, path, fmt="parquet"))
    assert back.count() == kept.count() == 20
