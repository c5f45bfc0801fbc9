"""Derived inputs built by Spark from the given ``pages`` table.

``cdx_lines`` turns every page into one or two CDX index lines (two
crawls), following the rules in FIXTURES.md section 3.  The same rules
are written once more in DuckDB SQL (``crawlsieve.plans.oracle``) so the
two engines can be compared.  Everything here is narrow (no shuffle):
each page expands to at most two lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture (FIXTURES.md section 3).
CRAWLS = ("CC-MAIN-2024-30", "CC-MAIN-2024-33")
LINES_PER_BLOCK = 25
EPOCH_BASE = 1720915200
EPOCH_STEP = 7919
CRAWL_STEP = 2592000
LANG_BY_SEGMENT = {"en": "eng", "fr": "fra", "de": "deu"}  # anything else: "spa"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crawl_table(spark: SparkSession, crawls=CRAWLS) -> DataFrame:
    """(crawl, crawl_rank): the rank is the position in the given list."""
    return spark.createDataFrame([(c, i) for i, c in enumerate(crawls)], "crawl string, crawl_rank int")


def surt_of(url) -> "F.Column":
    host = F.regexp_extract(url, r"^[a-z]+://([^/]+)", 1)
    path = F.regexp_extract(url, r"^[a-z]+://[^/]+(/.*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)


def cdx_lines(pages: DataFrame) -> DataFrame:
    """``crawl, crawl_rank, block_id, line_no, line`` for every page."""
    pid = F.col("page_id")
    url = F.col("url")
    ranks = (F.when(pid % 3 == 0, F.array(F.lit(0), F.lit(1)))
              .when(pid % 5 == 1, F.array(F.lit(1)))
              .otherwise(F.array(F.lit(0))))
    r = F.col("crawl_rank")
    seg = F.regexp_extract(url, r"^[a-z]+://[^/]+/([^/?#]*)", 1)
    lang = F.lit("spa")
    for k, v in reversed(list(LANG_BY_SEGMENT.items())):
        lang = F.when(seg == k, F.lit(v)).otherwise(lang)
    languages = F.when(pid % 11 == 4, F.lit("")).otherwise(
        F.concat(F.lit(', "languages": "'),
                 F.when(pid % 13 == 6, F.lit("ind,")).otherwise(F.lit("")), lang, F.lit('"')))
    code = (pid + r) % 10
    status = F.when(code == 7, F.lit("404")).when(code == 8, F.lit("301")).otherwise(F.lit("200"))
    js = F.concat(
        F.lit('{"url": "'), url, F.lit('", "status": "'), status, F.lit('"'), languages,
        F.lit(', "length": "'), F.length(url).cast("string"),
        F.lit('", "offset": "'), (pid * 1000).cast("string"),
        F.lit('", "filename": "warc/'), (pid % 8).cast("string"), F.lit('.warc.gz"}'))
    js = F.when((pid + r) % 37 == 5, F.lit('{"url": "broken')).otherwise(js)
    ts = F.date_format(F.timestamp_seconds(F.lit(EPOCH_BASE) + pid * EPOCH_STEP + r * CRAWL_STEP),
                       "yyyyMMddHHmmss")
    crawl = F.when(r == 0, F.lit(CRAWLS[0])).otherwise(F.lit(CRAWLS[1]))
    return (pages.select(pid, url, F.explode(ranks).alias("crawl_rank"))
                 .select(crawl.alias("crawl"), r.cast("int").alias("crawl_rank"),
                         F.floor(pid / LINES_PER_BLOCK).cast("int").alias("block_id"),
                         (pid % LINES_PER_BLOCK).cast("int").alias("line_no"),
                         F.concat_ws(" ", surt_of(url), ts, js).alias("line")))


def cdx_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdx_lines(read_table(spark, sf_dir, "pages"))


def http_separator(page_id) -> "F.Column":
    """FIXTURES.md `warc`: page_id % 41 = 2 has no separator, % 7 = 3 uses LF LF."""
    return (F.when(page_id % 41 == 2, F.lit(""))
             .when(page_id % 7 == 3, F.lit("\n\n"))
             .otherwise(F.lit("\r\n\r\n")))


def http_messages(pages: DataFrame) -> DataFrame:
    """One HTTP response message per page: head + separator + html."""
    pid = F.col("page_id")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("html").cast("string"))
    return pages.select(pid, "url", "html", F.concat(head, http_separator(pid), F.col("html")).alias("raw"))


# --- written fixtures: gzip block files + index, archive files -----------------

BLOCKS_PER_FILE = 4096
INDEX_TEMPLATE = "{base}/index/{crawl}/cluster.idx"
BLOCK_TEMPLATE = "{base}/blocks/{crawl}/{file}"
WARC_TEMPLATE = "{base}/{file}"


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def write_blocks(lines: DataFrame, root: str, with_rejects: bool = False) -> None:
    """Write the `blocks` fixture: one gzip member per (crawl, block_id),
    lines in line order, members appended to ``cdx-NNNNN.gz`` files, and a
    tab-separated index (start key, file, offset, length, id) per crawl.

    Each block file and its index part are written by exactly one task, in
    block order; a retried task rewrites the same bytes (idempotent).

    ``with_rejects`` adds the `block_rejects` rows after each block row, by
    block id modulo 4: 1 -> only three fields, 2 -> offset ``x``, 3 -> empty
    length, 0 -> a valid copy whose start key begins with a double quote.
    """
    blocks = (lines.groupBy("crawl", "block_id")
                   .agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("_l"))
                   .select("crawl", "block_id",
                           F.concat(F.array_join(F.transform("_l", lambda x: x["line"]), "\n"),
                                    F.lit("\n")).alias("text"),
                           F.get(F.col("_l"), 0)["line"].alias("first_line"),
                           F.floor(F.col("block_id") / BLOCKS_PER_FILE).cast("int").alias("file_no")))
    from crawlsieve.sources.ranged import work_partitions
    planned = (blocks.repartitionByRange(work_partitions(lines.sparkSession), "crawl", "file_no")
                     .sortWithinPartitions("crawl", "file_no", "block_id"))
    base, rejects = root, with_rejects

    def write(batches):
        import gzip
        import os
        import pyarrow as pa
        import pyarrow.fs as pafs

        def open_out(path):
            path = _local(path)
            if "://" in path:
                fs, p = pafs.FileSystem.from_uri(path)
                return fs.open_output_stream(p, compression=None)
            os.makedirs(os.path.dirname(path), exist_ok=True)
            return pafs.LocalFileSystem().open_output_stream(path, compression=None)

        cur, fh, pos, idx = None, None, 0, []
        done = {"crawl": [], "file": [], "blocks": []}

        def finish():
            if fh is None:
                return
            fh.close()
            ih = open_out(INDEX_TEMPLATE.format(base=base, crawl=cur[0]) + f"/part-{cur[1]:05d}.tsv")
            ih.write("".join(idx).encode("utf-8"))
            ih.close()
            done["crawl"].append(cur[0])
            done["file"].append(f"cdx-{cur[1]:05d}.gz")
            done["blocks"].append(len(idx) // (2 if rejects else 1))

        for b in batches:
            d = b.to_pydict()
            for i in range(b.num_rows):
                key = (d["crawl"][i], d["file_no"][i])
                if key != cur:
                    finish()
                    cur, pos, idx = key, 0, []
                    fh = open_out(BLOCK_TEMPLATE.format(base=base, crawl=key[0], file=f"cdx-{key[1]:05d}.gz"))
                member = gzip.compress(d["text"][i].encode("utf-8"), mtime=0)
                fh.write(member)
                start = " ".join(d["first_line"][i].split(" ")[:2])
                fname, bid = f"cdx-{key[1]:05d}.gz", d["block_id"][i] + 1
                idx.append(f"{start}\t{fname}\t{pos}\t{len(member)}\t{bid}\n")
                if rejects:
                    idx.append({1: f"{start}\t{fname}\t{pos}\n",
                                2: f"{start}\t{fname}\tx\t{len(member)}\t{bid}\n",
                                3: f"{start}\t{fname}\t{pos}\t\t{bid}\n",
                                0: f"\"{start}\t{fname}\t{pos}\t{len(member)}\t{bid}\n"}[bid % 4])
                pos += len(member)
        finish()
        yield pa.RecordBatch.from_pydict(done, schema=pa.schema(
            [("crawl", pa.string()), ("file", pa.string()), ("blocks", pa.int64())]))

    (planned.mapInArrow(write, "crawl string, file string, blocks bigint")
            .write.mode("overwrite").parquet(f"{root}/blocks_written"))


PAGES_PER_ARCHIVE_FILE = 4096


def warc_filename(page_id) -> "F.Column":
    """``warc/<page_id % 8>/<page_id div 4096>.warc.gz``: the eight archive
    groups of the fixture, each split into files of at most 4,096 pages so
    that no writer task receives an unbounded share of the pages."""
    return F.concat(F.lit("warc/"), (page_id % 8).cast("string"), F.lit("/"),
                    F.lpad(F.floor(page_id / PAGES_PER_ARCHIVE_FILE).cast("string"), 5, "0"),
                    F.lit(".warc.gz"))


def warc_records(pages: DataFrame) -> DataFrame:
    """Per page three archive records (request, response, metadata) as text."""
    pid = F.col("page_id")
    crlf = "\r\n"
    msgs = http_messages(pages)
    path = F.regexp_extract("url", r"^[a-z]+://[^/]+(/.*)$", 1)
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    req = F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1" + crlf + "Host: "), host, F.lit(crlf + crlf))
    meta = F.concat(F.lit("fetchTimeMs: "), (pid % 997).cast("string"), F.lit(crlf))
    recs = F.array(
        F.struct(F.lit(0).alias("record_no"), F.lit("request").alias("warc_type"), req.alias("payload")),
        F.struct(F.lit(1).alias("record_no"), F.lit("response").alias("warc_type"), F.col("raw").alias("payload")),
        F.struct(F.lit(2).alias("record_no"), F.lit("metadata").alias("warc_type"), meta.alias("payload")))
    return (msgs.select(pid, "url", warc_filename(pid).alias("filename"),
                        F.explode(recs).alias("r"))
                .select("page_id", "url", "filename", "r.record_no", "r.warc_type", "r.payload"))


def write_warc(pages: DataFrame, root: str) -> DataFrame:
    """Write the `warc` fixture; returns the manifest (filename, offset,
    length, page_id) with one range per page covering its three records."""
    from crawlsieve.sources.ranged import work_partitions
    recs = (warc_records(pages).repartitionByRange(work_partitions(pages.sparkSession), "filename")
                               .sortWithinPartitions("filename", "page_id", "record_no"))
    base = root

    def write(batches):
        import gzip
        import os
        import pyarrow as pa
        import pyarrow.fs as pafs
        fs = pafs.LocalFileSystem() if "://" not in base else pafs.FileSystem.from_uri(base)[0]
        cur, fh, pos = None, None, 0
        out = {k: [] for k in ("filename", "page_id", "offset", "length")}
        for b in batches:
            d = b.to_pydict()
            for i in range(b.num_rows):
                fname = d["filename"][i]
                if fname != cur:
                    if fh is not None:
                        fh.close()
                    path = _local(WARC_TEMPLATE.format(base=base, file=fname))
                    if "://" not in path:
                        os.makedirs(os.path.dirname(path), exist_ok=True)
                    fh = fs.open_output_stream(path if "://" not in path else path.split("://", 1)[1],
                                               compression=None)
                    cur, pos = fname, 0
                payload = d["payload"][i].encode("utf-8")
                head = (f"WARC/1.0\r\nWARC-Type: {d['warc_type'][i]}\r\nWARC-Target-URI: {d['url'][i]}\r\n"
                        f"WARC-Record-ID: <urn:rec:{d['page_id'][i]}:{d['record_no'][i]}>\r\n"
                        f"Content-Length: {len(payload)}\r\n\r\n").encode("utf-8")
                member = gzip.compress(head + payload + b"\r\n\r\n", mtime=0)
                fh.write(member)
                if d["record_no"][i] == 0:      # a page's range starts at its first record
                    out["filename"].append(fname)
                    out["page_id"].append(d["page_id"][i])
                    out["offset"].append(pos)
                    out["length"].append(0)
                out["length"][-1] += len(member)
                pos += len(member)
        if fh is not None:
            fh.close()
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("filename", pa.string()), ("page_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())]))

    manifest_path = f"{root}/warc_manifest"
    (recs.mapInArrow(write, "filename string, page_id bigint, offset bigint, length bigint")
         .write.mode("overwrite").parquet(manifest_path))
    return pages.sparkSession.read.parquet(manifest_path)
