"""Byte-range reads of gzip members as Spark jobs.

The unit of work is one manifest row ``(file, offset, length)``.  Rows are
dealt to tasks by bytes, neighbouring ranges are one request (``sources.ranges``),
so a task reads a contiguous, sorted run of ranges of few files (one open per
file per task) and a big file can still spread over several tasks.  Each task
streams Arrow batches through ``mapInArrow``; output batches are capped
by bytes so a task never holds more than a few MB of decoded text.

Paths are qualified by the session's default file system, as Spark does, and
opened through ``pyarrow.fs`` (local, HDFS, S3 also as ``s3a``, GCS); a failed
range becomes an ``error`` value on its row and the rest of the partition
continues, but a scheme that nothing can open fails the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsieve.files import open_path, qualified
from crawlsieve.schemas import ARCHIVE_RECORD, BLOCK_TEXT
from crawlsieve.sources import ranges

OUT_BATCH_BYTES = 32 * 1024 * 1024


class RangeReader:
    """Keeps the last opened file per task; reads inclusive byte ranges."""

    def __init__(self):
        self._path = None
        self._fh = None

    def read(self, path: str, offset: int, length: int) -> bytes:
        if path != self._path:
            self.close()
            fs, p = open_path(path)
            self._fh = fs.open_input_file(p)
            self._path = path
        if offset < 0 or length <= 0:
            raise ValueError(f"bad range {offset}+{length}")
        data = self._fh.read_at(length, offset)
        data = data.to_pybytes() if hasattr(data, "to_pybytes") else bytes(data)
        if len(data) != length:
            raise EOFError(f"short read: {len(data)} of {length} bytes")
        return data

    def close(self):
        if self._fh is not None:
            try:
                self._fh.close()
            except Exception:
                pass
        self._fh, self._path = None, None


def _error_label(e: BaseException) -> str:
    return type(e).__name__


def work_partitions(spark) -> int:
    """Partition count for manifest-driven jobs.

    A manifest is a few bytes per row but each row is a fetch + gunzip, so
    byte-based coalescing (AQE) would pack it into one task.  An explicit
    count is never coalesced; it follows the cluster's shuffle setting.
    """
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    try:
        return max(spark.sparkContext.defaultParallelism, shuffle)
    except Exception:
        return shuffle


def _plan_ranges(manifest: DataFrame, path: str, offset: str, length: str, num_partitions: int | None) -> DataFrame:
    return ranges.planned(manifest, path, offset, length, num_partitions or work_partitions(manifest.sparkSession))


# --- S3/S4: index blocks --------------------------------------------------------

def read_blocks(index: DataFrame, path_template: str, base: str = "",
                num_partitions: int | None = None) -> DataFrame:
    """Fetch every index block: ``index`` rows (crawl, block_id, cdx_filename,
    cdx_offset, cdx_length, ...) -> one row per block with the decompressed
    ``text`` or an ``error`` label.  ``path_template`` is formatted with
    ``base``, ``crawl`` and ``file``.
    """
    path = F.format_string(path_template.replace("{base}", base.replace("%", "%%"))
                           .replace("{crawl}", "%1$s").replace("{file}", "%2$s"),
                           F.col("crawl"), F.col("cdx_filename"))
    manifest = index.select("crawl", "block_id", "cdx_filename", "cdx_offset", "cdx_length",
                            qualified(index.sparkSession, path).alias("_path"))
    planned = _plan_ranges(manifest, "_path", "cdx_offset", "cdx_length", num_partitions)
    schema = BLOCK_TEXT
    names = [f.name for f in schema.fields]

    def run(batches):
        import gzip
        import pyarrow as pa
        reader = RangeReader()
        buf = {n: [] for n in names}
        size = 0

        from pyspark.sql.pandas.types import to_arrow_schema
        pa_schema = to_arrow_schema(schema)

        def flush():
            nonlocal buf, size
            out = pa.RecordBatch.from_pydict(buf, schema=pa_schema)
            buf = {n: [] for n in names}
            size = 0
            return out

        for row, raw, failure in ranges.fetched(batches, reader, "_path", "cdx_offset", "cdx_length"):
            text = None
            if failure is None:
                try:
                    text = gzip.decompress(raw).decode("utf-8", errors="replace")
                except Exception as e:  # noqa: BLE001 - one failed block never fails the task
                    failure = e
            for n in ("crawl", "block_id", "cdx_filename", "cdx_offset", "cdx_length"):
                buf[n].append(row[n])
            buf["text"].append(text)
            buf["n_bytes"].append(len(text.encode("utf-8")) if text is not None else None)
            buf["error"].append(None if failure is None else _error_label(failure))
            size += len(text) if text else 0
            if size >= OUT_BATCH_BYTES:
                yield flush()
        reader.close()
        if buf["crawl"]:
            yield flush()

    return planned.mapInArrow(run, schema)


def block_lines(blocks: DataFrame) -> DataFrame:
    """Explode fetched blocks into non-empty lines (JVM side).

    ``line_no`` is the position of the line inside its block.
    """
    return (blocks.where(F.col("error").isNull())
                  .select("crawl", "block_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
                  .where(F.col("line") != "")
                  .withColumn("line_no", F.col("line_no").cast("int")))


# --- S5 + P4: archive records ---------------------------------------------------

ARCHIVE_SCHEMA = ARCHIVE_RECORD


def split_http(payload: bytes):
    """P4 on bytes: earliest CRLF CRLF or LF LF; body after the matched separator."""
    a = payload.find(b"\r\n\r\n")
    b = payload.find(b"\n\n")
    if a < 0 and b < 0:
        return None, None
    if b < 0 or (a >= 0 and a <= b):
        return payload[:a], payload[a + 4:]
    return payload[:b], payload[b + 2:]


def _dechunk(body: bytes) -> bytes:
    out, pos = [], 0
    while True:
        eol = body.find(b"\r\n", pos)
        if eol < 0:
            break
        try:
            size = int(body[pos:eol].split(b";")[0].strip() or b"0", 16)
        except ValueError:
            return body                      # not really chunked: keep as is
        if size == 0:
            break
        out.append(body[eol + 2:eol + 2 + size])
        pos = eol + 2 + size + 2
    return b"".join(out)


def decode_http_body(head: bytes, body: bytes) -> str:
    """Body bytes -> text: undo chunked transfer and gzip/deflate content
    encoding when the head declares them, then decode with the declared
    charset (UTF-8 otherwise), replacing undecodable bytes."""
    import codecs
    import re
    import zlib

    h = head.decode("latin-1").lower()
    if re.search(r"^transfer-encoding:\s*chunked", h, re.M):
        body = _dechunk(body)
    enc = re.search(r"^content-encoding:\s*([a-z0-9-]+)", h, re.M)
    if enc and enc.group(1) in ("gzip", "x-gzip", "deflate"):
        try:
            wbits = 47 if enc.group(1) != "deflate" else zlib.MAX_WBITS
            body = zlib.decompress(body, wbits)
        except zlib.error:
            try:
                body = zlib.decompress(body, -zlib.MAX_WBITS)
            except zlib.error:
                pass
    cs = re.search(r"^content-type:.*?charset=[\"']?([a-z0-9_.:-]+)", h, re.M)
    charset = "utf-8"
    if cs:
        try:
            charset = codecs.lookup(cs.group(1)).name
        except LookupError:
            pass
    return body.decode(charset, errors="replace")


def parse_warc(data: bytes):
    """Yield (warc_type, target_uri, content_length, payload) per record;
    raises ValueError on malformed record data."""
    pos, n = 0, len(data)
    while pos < n:
        while data.startswith(b"\r\n", pos):
            pos += 2
        if pos >= n:
            break
        end = data.find(b"\r\n\r\n", pos)
        if end < 0 or not data.startswith(b"WARC/", pos):
            raise ValueError("bad WARC header")
        headers = {}
        for line in data[pos:end].split(b"\r\n")[1:]:
            k, _, v = line.partition(b":")
            headers[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", errors="replace")
        try:
            clen = int(headers["content-length"])
        except (KeyError, ValueError) as e:
            raise ValueError("bad Content-Length") from e
        start = end + 4
        if start + clen > n:
            raise ValueError("truncated record")
        yield headers.get("warc-type"), headers.get("warc-target-uri"), clen, data[start:start + clen]
        pos = start + clen


def read_archive_records(manifest: DataFrame, path_template: str = "{file}", base: str = "",
                         filename: str = "filename", offset: str = "offset", length: str = "length",
                         carry=(), num_partitions: int | None = None) -> DataFrame:
    """Fetch each manifest range, gunzip, emit one row per archive record.

    Response records also get ``http_head`` / ``body`` (P4; ``error`` is
    ``no_body`` when the head has no blank line); the body is de-chunked,
    inflated and decoded per its declared encodings and charset.  A failed fetch yields
    one row with ``record_no = -1`` and the error label; malformed record
    data ends that item after the records already read.
    """
    path = F.format_string(path_template.replace("{base}", base.replace("%", "%%")).replace("{file}", "%1$s"),
                           F.col(filename))
    carry = list(carry)
    m = manifest.select(*carry, F.col(filename).alias("filename"), F.col(offset).cast("bigint").alias("offset"),
                        F.col(length).cast("bigint").alias("length"),
                        qualified(manifest.sparkSession, path).alias("_path"))
    planned = _plan_ranges(m, "_path", "offset", "length", num_partitions)
    schema = T.StructType([m.schema[c] for c in carry] + ARCHIVE_SCHEMA.fields)
    names = [f.name for f in schema.fields]

    def run(batches):
        import gzip
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        pa_schema = to_arrow_schema(schema)
        reader = RangeReader()
        buf = {k: [] for k in names}
        size = 0

        def add(**row):
            nonlocal size
            for k in names:
                buf[k].append(row.get(k))
            size += len(row.get("body") or "")

        def flush():
            nonlocal buf, size
            out = pa.RecordBatch.from_pydict(buf, schema=pa_schema)
            buf = {k: [] for k in names}
            size = 0
            return out

        for row, raw, failure in ranges.fetched(batches, reader, "_path", "offset", "length"):
            key = {c: row[c] for c in (*carry, "filename", "offset", "length")}
            if failure is None:
                try:
                    data = gzip.decompress(raw)
                except Exception as e:  # noqa: BLE001
                    failure = e
            if failure is not None:
                add(**key, record_no=-1, error=_error_label(failure))
                continue
            rec_no = 0
            try:
                for wtype, uri, clen, payload in parse_warc(data):
                    head = body = err = None
                    if wtype == "response":
                        h, bd = split_http(payload)
                        if h is None:
                            err = "no_body"
                        else:
                            head = h.decode("utf-8", errors="replace")
                            body = decode_http_body(h, bd)
                    add(**key, record_no=rec_no, warc_type=wtype, target_uri=uri, content_length=clen,
                        http_head=head, body=body, n_bytes=len(data) if rec_no == 0 else 0, error=err)
                    rec_no += 1
            except ValueError as e:
                add(**key, record_no=rec_no, error=f"bad_record:{e}")
            if size >= OUT_BATCH_BYTES:
                yield flush()
        reader.close()
        if buf["filename"]:
            yield flush()

    return planned.mapInArrow(run, schema)


def filter_warc_response(records: DataFrame) -> DataFrame:
    """keep response records."""
    return records.where(F.col("warc_type") == "response")
