"""Index rules on rows of our own: reading, language and status filters, batches."""

import gzip

from pyspark.sql import functions as F

from crawlsieve.operators.batching import batch_fixed_size
from crawlsieve.plans import index_stage
from crawlsieve.sources import index as ixsrc
from crawlsieve.sources import ranged

CRAWL = "CC-MAIN-2031-07"
INDEX = [(f"org,sample{i})/page 2031020{i}101500", "part-7.gz", str(1000 * i), str(900 + i), str(i)) for i in (1, 2, 3)]


def entry(n: int, status: str = "200", languages: str | None = "eng") -> str:
    """One index line."""
    lang = "" if languages is None else f'"languages": "{languages}", '
    return (f'org,sample)/item-{n} 20310201{n:06d} {{"url": "https://sample.org/item-{n}", {lang}"status": "{status}", '
            f'"offset": "{n * 10}", "length": "10", "filename": "archive/{n}.gz"}}')


def write_index(folder, rows, sep="\t"):
    (folder / CRAWL).mkdir(parents=True, exist_ok=True)
    (folder / CRAWL / "cluster.idx").write_text("\n".join(sep.join(r) for r in rows) + "\n")


def read_index(spark, folder, **kw):
    return ixsrc.read_block_index(spark, CRAWL, "{base}/{crawl}/cluster.idx", str(folder), **kw)


def lines_of(spark, folder, text: str, n_blocks: int = 3):
    """The lines of n equal gzip blocks, read through their index."""
    member = gzip.compress(text.encode(), mtime=0)
    write_index(folder, [(f"org,sample)/{i} 20310201000000", "all.gz", str(i * len(member)), str(len(member)), str(i + 1))
                         for i in range(n_blocks)])
    (folder / CRAWL / "all.gz").write_bytes(member * n_blocks)
    blocks = ranged.read_blocks(read_index(spark, folder), "{base}/{crawl}/{file}", str(folder))
    return ranged.block_lines(blocks).withColumn("crawl_rank", F.lit(0))


def n_batches(lines, size):
    return index_stage.index_batches(lines, batch_size=size).select("crawl", "batch_no").distinct().count()


def test_index_fields_are_typed(spark, tmp_path):
    write_index(tmp_path, INDEX)
    got = sorted((f"{r.start_key} {r.start_ts}", r.cdx_filename, r.cdx_offset, r.cdx_length, r.block_id)
                 for r in read_index(spark, tmp_path).collect())
    assert got == [(k, f, int(o), int(n), int(b)) for k, f, o, n, b in INDEX]


def test_index_rows_without_an_id_are_read(spark, tmp_path):
    """Four fields are enough: the id is only a number for the block."""
    write_index(tmp_path, [r[:4] for r in INDEX])
    got = read_index(spark, tmp_path).collect()
    assert sorted(r.cdx_offset for r in got) == [1000, 2000, 3000] and len({r.block_id for r in got}) == 3
    assert sorted(r.block_id for r in read_index(spark, tmp_path).collect()) == sorted(r.block_id for r in got)


def test_entries_in_no_language_make_no_batch(spark, tmp_path):
    assert n_batches(lines_of(spark, tmp_path, entry(1, languages=None) + "\n"), 2) == 0


def test_redirects_make_no_batch(spark, tmp_path):
    assert n_batches(lines_of(spark, tmp_path, entry(1, status="301") + "\n"), 2) == 0


def test_batches_are_cut_across_blocks(spark, tmp_path):
    lines = lines_of(spark, tmp_path, "\n".join([entry(1), entry(2)]))
    kept = index_stage.kept_entries(lines, dedup=False)
    assert batch_fixed_size(kept, 2).select("batch_no").distinct().count() == 3
    assert batch_fixed_size(kept, 4).select("batch_no").distinct().count() == 2


def test_one_of_several_languages_is_enough(spark):
    lines = [entry(4), entry(5, languages="swe,eng"), entry(6, languages=None), entry(7, languages="swe")]
    df = index_stage.parsed_lines(spark.createDataFrame([(x,) for x in lines], "line string"))
    got = {r.surt_url: (r.timestamp, r.outcome) for r in df.collect()}
    assert got["org,sample)/item-4"] == ("20310201000004", "pass")
    assert [got[f"org,sample)/item-{n}"][1] for n in (5, 6, 7)] == ["pass", "language", "language"]


def test_blank_separated_index(spark, tmp_path):
    write_index(tmp_path, INDEX, sep="   ")
    assert sorted(r.cdx_length for r in read_index(spark, tmp_path, sep="whitespace").collect()) == [901, 902, 903]


def test_crawl_paths_that_share_a_prefix(spark, tmp_path):
    for crawl in ("CC-MAIN-2031-0", "CC-MAIN-2031-07"):
        (tmp_path / crawl).mkdir()
        (tmp_path / crawl / "cluster.idx").write_text("\t".join(INDEX[0]) + "\n")
    df = ixsrc.read_block_index(spark, "CC-MAIN-2031-0,CC-MAIN-2031-07", "{base}/{crawl}", str(tmp_path))
    assert sorted((r.crawl, r.crawl_rank) for r in df.collect()) == [("CC-MAIN-2031-0", 0), ("CC-MAIN-2031-07", 1)]
