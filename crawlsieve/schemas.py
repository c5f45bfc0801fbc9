"""Explicit schemas (never inferred)."""

from pyspark.sql import types as T

CRAWL_PREFIX = "CC-MAIN-"

# The raw tab-separated columns, read as strings and typed afterwards.
BLOCK_INDEX_RAW = T.StructType([
    T.StructField("c0", T.StringType()),
    T.StructField("c1", T.StringType()),
    T.StructField("c2", T.StringType()),
    T.StructField("c3", T.StringType()),
    T.StructField("c4", T.StringType()),
])

METADATA_MAP = T.MapType(T.StringType(), T.StringType())

# A CDX entry as it travels in a batch message.
CDX_ENTRY = T.StructType([
    T.StructField("surt_url", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("metadata", METADATA_MAP),
])

BATCH_MESSAGE = T.ArrayType(CDX_ENTRY)

# Output of the ranged index-block read.
BLOCK_TEXT = T.StructType([
    T.StructField("crawl", T.StringType()),
    T.StructField("block_id", T.LongType()),
    T.StructField("cdx_filename", T.StringType()),
    T.StructField("cdx_offset", T.LongType()),
    T.StructField("cdx_length", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("error", T.StringType()),
])

# Output of the archive-record scan: one row per record (or one error row);
# response records carry the HTTP head and the decoded body.
ARCHIVE_RECORD = T.StructType([
    T.StructField("filename", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("record_no", T.IntegerType()),
    T.StructField("warc_type", T.StringType()), T.StructField("target_uri", T.StringType()),
    T.StructField("content_length", T.LongType()), T.StructField("http_head", T.StringType()),
    T.StructField("body", T.StringType()), T.StructField("n_bytes", T.LongType()),
    T.StructField("error", T.StringType()),
])

# The 7-column document contract written by the document sink.
DOCUMENT = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("full_text", T.StringType()),
    T.StructField("tokens", T.ArrayType(T.IntegerType())),
    T.StructField("token_count", T.IntegerType()),
    T.StructField("char_count", T.IntegerType()),
    T.StructField("filename", T.StringType()),
])

