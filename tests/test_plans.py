"""Plan-shape checks: the properties the scale design relies on."""

import re

from conftest import SF001
from crawlsieve.plans.registry import QUERIES


def _plan(spark, name) -> str:
    df = QUERIES[name](spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_partially_aggregated(spark):
    for name in ("dedup_first_seen", "dedup_latest"):
        p = _plan(spark, name)
        assert "partial_m" in p and "SortAggregate" not in p, name
        for line in p.split("\n"):     # the only window is over the position, which is unique
            assert "Window [" not in line or ("_place" in line and "url_key" not in line and "surt" not in line.split("AS _rn")[1]), name


def test_funnel_uses_hash_aggregation_only(spark):
    p = _plan(spark, "funnel_index")
    assert "SortAggregate" not in p and "HashAggregate" in p


def test_no_single_partition_exchange_in_batching(spark):
    for name in ("batch_fixed_size", "batch_messages", "batch_per_block", "batch_threshold"):
        assert "SinglePartition" not in _plan(spark, name), name


def test_index_side_scans_prune_html(spark):
    for name in ("cdx_parse", "dedup_first_seen", "batch_fixed_size", "funnel_index"):
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", _plan(spark, name)):
            assert "html" not in schema, name


def test_range_reads_are_dealt_by_bytes(spark):
    for name in ("cdx_block_scan", "warc_record_scan"):
        p = _plan(spark, name)
        below = p.split("MapInArrow")[1]
        assert "Sort [_path" in below and "_task" in below and "REPARTITION_BY_NUM" in below, name


def test_flat_text_chain_evaluated_once(spark):
    p = _plan(spark, "document_records")
    assert p.count("<script") == 1          # the scrub pattern appears in one expression only
    assert "Generate" in p


def test_worker_upload_batches_do_not_shuffle_documents(spark):
    from crawlsieve.operators import batching
    from crawlsieve.plans import fixtures
    docs = fixtures.read_table(spark, SF001, "documents").select("doc_id", "text")
    p = batching.batch_threshold(docs, lane=None, order=("doc_id",), text="text")
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_cdx_json_parsed_once_per_line(spark):
    for name in ("filter_status", "cdx_parse"):
        assert _plan(spark, name).count("from_json(") == 1, name
    # its two branches read the written table of passed lines
    assert "from_json(" not in _plan(spark, "dedup_first_seen")


def test_bucketed_seen_table_is_not_shuffled(spark):
    from crawlsieve.operators import dedup
    from crawlsieve.plans import fixtures, index_stage
    from crawlsieve.session import scratch_path
    passed = index_stage.kept_entries(fixtures.cdx_from_dir(spark, SF001), dedup=False)
    name = "seen_plan_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    dedup.append_seen_bucketed(passed.where("crawl_rank = 0"), name, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = dedup.dedup_incremental(passed.where("crawl_rank = 1"), dedup.read_seen(spark, name))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    seen_scan = [l for l in plan.split("\n") if name in l and "FileScan" in l]
    assert seen_scan and "Bucketed: true" in seen_scan[0]
    # the line directly above the bucketed scan is the join input, not an exchange
    lines = plan.split("\n")
    i = lines.index(seen_scan[0])
    assert "Exchange" not in lines[i - 1]
