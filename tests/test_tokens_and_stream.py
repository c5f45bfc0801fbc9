"""Tokenizer invariants (P8), batch times (A9) and stream replay (T4/T5)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from crawlsieve.operators import tokenize
from crawlsieve.plans import fixtures, index_stage
from crawlsieve.plans.registry import QUERIES
from crawlsieve.session import scratch_path
from crawlsieve.streaming import worker


def test_token_invariants(spark):
    docs = fixtures.read_table(spark, SF001, "documents")
    vocab = tokenize.fit_vocab(docs, "text", 2000)
    assert vocab[:5] == tokenize.SPECIAL_TOKENS
    toks = tokenize.tokenize(docs.select("doc_id", "text"), vocab, text="text")
    rows = toks.select("doc_id", "tokens").collect()
    assert len(rows) == docs.count()
    cls, sep = vocab.index("[CLS]"), vocab.index("[SEP]")
    for r in rows:
        assert 2 <= len(r.tokens) <= 512
        assert r.tokens[0] == cls and r.tokens[-1] == sep
    # repartition-invariant
    again = {r.doc_id: list(r.tokens) for r in tokenize.tokenize(
        docs.select("doc_id", "text").repartition(3), vocab, text="text").collect()}
    assert again == {r.doc_id: list(r.tokens) for r in rows}


def test_tokenize_query_rows(spark):
    df = QUERIES["tokenize_documents"](spark, SF001)
    assert df.count() == 178
    assert df.where((F.col("token_count") > 512) | (F.col("first_id") != 2) | (F.col("last_id") != 3)).count() == 0


def test_stream_dedup_replay_is_idempotent(spark):
    lines_dir = scratch_path(spark, "lines")
    lines = fixtures.cdx_from_dir(spark, SF001)
    out, seen, ckpt = (scratch_path(spark, n) for n in ("o", "s", "c"))

    def parse(df):
        return (index_stage.parsed_lines(df).where("outcome = 'pass'")
                .select(*index_stage.LINEAGE, "surt_url", "timestamp", "metadata"))

    n_batches = 0
    for c in fixtures.CRAWLS:          # files arrive per crawl; the stream restarts in between
        lines.where(F.col("crawl") == c).write.mode("append").parquet(lines_dir)
        q = worker.start_index_dedup(spark, lines_dir, out, seen, ckpt, parse)
        assert q.awaitTermination(300)
        n_batches += len(q.recentProgress)
    assert n_batches >= 2
    first = sorted(tuple(r) for r in spark.read.parquet(out).select("crawl", "block_id", "line_no").collect())
    # restart on the same checkpoint: nothing new, nothing duplicated
    q2 = worker.start_index_dedup(spark, lines_dir, out, seen, ckpt, parse)
    assert q2.awaitTermination(300)
    second = sorted(tuple(r) for r in spark.read.parquet(out).select("crawl", "block_id", "line_no").collect())
    assert first == second
    assert len(first) == 20


def test_worker_stream_processing_time_trigger(spark):
    """A processing-time trigger flushes whatever arrived; restart safe."""
    from crawlsieve.plans.registry import _batches_with_archive_ranges
    batches_dir, warc_root = _batches_with_archive_ranges(spark, SF001)
    out, ckpt = scratch_path(spark, "wo"), scratch_path(spark, "wc")
    q = worker.start_worker(spark, batches_dir, out, ckpt, fixtures.WARC_TEMPLATE, warc_root, None,
                            trigger="1 second", max_files_per_trigger=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    times = worker.batch_times(spark, f"{out}_audit")
    assert times.count() >= 1 and times.where("ms <= 0").count() == 0
    docs = worker.read_worker_output(spark, out)
    n = docs.count()
    assert n > 0
    audit = worker.read_audit(spark, f"{out}_audit")
    assert audit.groupBy().sum("rows").first()[0] == n
    assert audit.where("rows > 0 AND files < 1").count() == 0
    assert audit.where("status = 'attempt'").count() == audit.where("status = 'ok'").count() == times.count()
    assert worker.read_rejects(spark, out).where("error <> 'no_body'").count() == 0
    assert docs.select("url").distinct().count() == n     # no duplicates across micro-batches


def test_failed_micro_batch_is_in_the_audit(spark, monkeypatch):
    from crawlsieve.plans import jobs
    from crawlsieve.plans.registry import _batches_with_archive_ranges
    batches_dir, warc_root = _batches_with_archive_ranges(spark, SF001)
    out, ckpt = scratch_path(spark, "wo"), scratch_path(spark, "wc")

    def start():
        return worker.start_worker(spark, batches_dir, out, ckpt, fixtures.WARC_TEMPLATE, warc_root, None)

    with monkeypatch.context() as m:
        m.setattr(jobs, "documents_of", lambda *a, **k: 1 / 0)
        with pytest.raises(Exception):
            start().awaitTermination()
    start().awaitTermination()
    events = [r.status for r in worker.read_audit(spark, f"{out}_audit").where("batch_id = 0").collect()]
    assert sorted(events) == ["attempt", "attempt", "failed", "ok"]


def test_vocab_from_file_and_dict(spark, tmp_path):
    words = tokenize.vocab_from_words(["hello", "world"])
    path = tmp_path / "vocab.txt"
    path.write_text("\n".join(words) + "\n")
    assert tokenize.load_vocab(spark, str(path)) == words
    assert tokenize.load_vocab(spark, {t: i for i, t in enumerate(words)}) == words
    df = spark.createDataFrame([(1, "Hello world")], "id int, t string")
    a = tokenize.tokenize(df, str(path), text="t").first().tokens
    b = tokenize.tokenize(df, words, text="t").first().tokens
    assert a == b == [2, words.index("hello"), words.index("world"), 3]
