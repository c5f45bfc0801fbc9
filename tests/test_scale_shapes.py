"""Shapes that appear at scale: 1,000,000-character documents and a hot key
holding a third of all rows."""

from pyspark.sql import functions as F

from crawlsieve.functions import text as textf
from crawlsieve.operators import batching, dedup, extract, tokenize


def _big_html(n_paras: int) -> str:
    para = "<p>" + ("word " * 40) + "&amp; more</p>"
    return ("<html><head><script>" + "var x='</p>';" * 2000 + "</script></head><body><article>"
            + para * n_paras + "</article><!-- " + "c" * 100000 + " --></body></html>")


def test_million_char_document(spark):
    html = _big_html(4500)
    assert len(html) > 1_000_000
    df = spark.createDataFrame([(1, html)], "id int, html string")
    flat = df.select(textf.flat_text("html").alias("t")).first().t
    assert flat.startswith("word word") and "<" not in flat and len(flat) > 900_000
    main = extract.main_text(df, ("id",), "html", "t").first().t
    assert main.count("\n") == 4499
    vocab = tokenize.vocab_from_words(["word", "more"])
    toks = tokenize.tokenize(df.select("id", F.lit(flat).alias("t")), vocab, text="t").first().tokens
    assert len(toks) == 512


def test_hot_key_dedup_and_lane(spark):
    n = 30000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot)/")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"), F.lit(")/"))).alias("surt_url"),
        F.lit("20240101000000").alias("timestamp"),
        (F.col("id") % 2).cast("int").alias("crawl_rank"),
        F.floor(F.col("id") / 100).cast("int").alias("block_id"),
        (F.col("id") % 100).cast("int").alias("line_no"),
        F.lit("c").alias("crawl"),
        F.create_map(F.lit("k"), F.lit("v")).alias("metadata")).repartition(16)
    kept = dedup.dedup_first_seen(rows)
    assert kept.count() == n - n // 3 + 1
    hot = kept.where(F.col("surt_url") == "hot)/").first()
    assert (hot.crawl_rank, hot.block_id, hot.line_no) == (0, 0, 0)
    docs = rows.select(F.col("surt_url").alias("doc"), F.when(F.col("surt_url") == "hot)/", 0)
                       .otherwise(F.col("line_no") % 7 + 1).alias("lane"), F.col("block_id").alias("o1"),
                       F.col("line_no").alias("o2"), F.lit("x" * 10).alias("text"))
    b = batching.batch_threshold(docs, "lane", ("o1", "o2"), "text", max_docs=10, max_bytes=1e9)
    sizes = b.groupBy("lane", "upload_batch_no").count()
    assert sizes.where("count > 10").count() == 0
    assert b.where("lane = 0").count() == n // 3
