"""Property tests: funnel invariant, B1 two-level == global numbering,
repartition invariance of D1 / B1 / B3, dedup stats identity."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from crawlsieve.operators import batching, dedup, metrics
from crawlsieve.plans import index_stage

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

entry = st.tuples(
    st.integers(0, 1),                      # crawl rank
    st.integers(0, 6),                      # block
    st.integers(0, 30),                     # line
    st.sampled_from(["a)/", "b)/", "c)/x", "d)/y", "e)/"]),
    st.sampled_from(["eng", "fra", "ind,eng", None]),
    st.sampled_from(["200", "404", "301"]),
    st.booleans(),                          # broken json
)


def _lines(spark, rows):
    seen, out = set(), []
    for r, b, ln, surt, lang, status, broken in rows:
        if (r, b, ln) in seen:
            continue
        seen.add((r, b, ln))
        meta = {"status": status}
        if lang is not None:
            meta["languages"] = lang
        js = '{"url": "broken' if broken else json.dumps(meta)
        out.append((f"CC-MAIN-2024-3{r}", r, b, ln, f"{surt} 2024070{b}000000 {js}"))
    return spark.createDataFrame(out, "crawl string, crawl_rank int, block_id int, line_no int, line string")


@SETTINGS
@given(st.lists(entry, min_size=1, max_size=60))
def test_funnel_invariant_and_dedup_identity(spark, rows):
    parsed = index_stage.parsed_lines(_lines(spark, rows))
    for r in metrics.funnel_index(parsed).collect():
        assert r.total == r.parse_error + r.language + r.status + r.duplicate + r.kept
    passed = parsed.where("outcome = 'pass'")
    s = dedup.dedup_stats(passed).first()
    assert s.processed == s.unique_urls + s.skipped
    assert dedup.dedup_first_seen(passed.drop("outcome")).count() == s.unique_urls


@SETTINGS
@given(st.lists(entry, min_size=1, max_size=80), st.integers(1, 7), st.integers(1, 5))
def test_two_level_batches_equal_global_numbering(spark, rows, size, parts):
    kept = index_stage.kept_entries(_lines(spark, rows), dedup=True).repartition(parts)
    got = {(r.crawl, r.block_id, r.line_no): r.batch_no for r in batching.batch_fixed_size(kept, size).collect()}
    w = Window.partitionBy("crawl").orderBy("block_id", "line_no")
    ref = kept.withColumn("b", F.floor((F.row_number().over(w) - 1) / size))
    assert got == {(r.crawl, r.block_id, r.line_no): r.b for r in ref.collect()}


@SETTINGS
@given(st.lists(entry, min_size=1, max_size=80), st.integers(1, 6))
def test_dedup_is_repartition_invariant(spark, rows, parts):
    lines = _lines(spark, rows)
    a = {tuple(r) for r in index_stage.kept_entries(lines).select("crawl", "block_id", "line_no").collect()}
    b = {tuple(r) for r in index_stage.kept_entries(lines.repartition(parts)).select(
        "crawl", "block_id", "line_no").collect()}
    assert a == b


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 9000)), min_size=1, max_size=60),
       st.integers(1, 5), st.integers(1, 6))
def test_threshold_batches_match_sequential_fold(spark, docs, max_docs, parts):
    rows = [(i, lane, "x" * n) for i, (lane, n) in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, lane int, text string").repartition(parts)
    got = {r.doc_id: r.upload_batch_no for r in batching.batch_threshold(
        df, "lane", ("doc_id",), "text", max_docs=max_docs, max_bytes=12000).collect()}
    expect, state = {}, {}
    for i, lane, text in rows:  # rows are in doc_id order
        d, s, b = state.get(lane, (0, 0.0, 0))
        expect[i] = b
        d, s = d + 1, s + len(text) * 1.5
        if d >= max_docs or s >= 12000:
            d, s, b = 0, 0.0, b + 1
        state[lane] = (d, s, b)
    assert got == expect
