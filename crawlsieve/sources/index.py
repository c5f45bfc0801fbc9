"""Block-index sources (S1, S2, S7, S8) and the batch-message source.

The block index (``cluster.idx``) is plain tab-separated text; Spark's
text source splits it across tasks and each line is split on tab.  There
is no quote handling: a start key may begin with ``"`` and must not
swallow the following rows (the CSV source would need ``quote=''``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsieve.functions.cdx import parse_crawl_versions
from crawlsieve.schemas import BATCH_MESSAGE, BLOCK_INDEX_RAW

DEFAULT_INDEX_TEMPLATE = "{base}/cc-index/collections/{crawl}/indexes/cluster.idx"


def _read_raw(spark: SparkSession, paths, sep: str = "tab") -> DataFrame:
    """Lines split on tab: no quote handling at all, exact field counts
    (a missing field is NULL, an empty one is ``''``).  ``sep='whitespace'``
    reads the blank-separated form (6 tokens: key, timestamp, file, offset,
    length, id)."""
    raw = spark.read.text(paths).where(F.col("value") != "")
    if sep == "tab":
        parts = F.split(F.col("value"), "\t")
        cols = [F.get(parts, i) for i in range(5)]
        n = F.size(parts)
    elif sep == "whitespace":
        parts = F.split(F.trim(F.col("value")), "\\s+")
        cols = [F.concat_ws(" ", F.get(parts, 0), F.get(parts, 1))] + [F.get(parts, i) for i in range(2, 6)]
        n = F.size(parts) - 1
    else:
        raise ValueError(f"sep must be 'tab' or 'whitespace', got {sep!r}")
    return raw.select(*[c.alias(f.name) for c, f in zip(cols, BLOCK_INDEX_RAW.fields)],
                      n.alias("n_fields"), F.col("_metadata.file_path").alias("_file"))


def _typed(raw: DataFrame) -> DataFrame:
    parts = F.split(F.col("c0"), " ", 2)
    return raw.select(
        "*",
        F.get(parts, 0).alias("start_key"), F.get(parts, 1).alias("start_ts"),
        F.col("c1").alias("cdx_filename"),
        F.col("c2").try_cast("bigint").alias("cdx_offset"),
        F.col("c3").try_cast("bigint").alias("cdx_length"),
        F.when(F.col("n_fields") >= 5, F.col("c4").try_cast("bigint")).otherwise(_place_id()).alias("block_id"))


def _place_id() -> "F.Column":
    """Block number of a row without an id: from its file and offset, below zero,
    so that it never meets a given id."""
    return -1 - F.shiftrightunsigned(F.xxhash64("c1", "c2"), 1)


def _valid() -> "F.Column":
    return ((F.col("n_fields") >= 4) & F.col("cdx_filename").isNotNull() & (F.col("cdx_filename") != "")
            & F.col("cdx_offset").isNotNull() & (F.col("cdx_offset") >= 0)
            & F.col("cdx_length").isNotNull() & (F.col("cdx_length") > 0)
            & F.col("block_id").isNotNull())


def _reject_reason() -> "F.Column":
    return (F.when(F.col("n_fields") < 4, F.lit("too_few_fields"))
             .when(F.col("cdx_offset").isNull() | (F.col("cdx_offset") < 0), F.lit("bad_offset"))
             .when(F.col("cdx_length").isNull() | (F.col("cdx_length") <= 0), F.lit("bad_length"))
             .when(F.col("block_id").isNull(), F.lit("bad_id"))
             .otherwise(F.lit("bad_row")))


def crawl_names(crawls) -> list[str]:
    """Argument list -> ordered, de-duplicated crawl names (rank = position)."""
    return parse_crawl_versions(crawls) if isinstance(crawls, str) else parse_crawl_versions(",".join(crawls))


def crawl_table(spark: SparkSession, crawls) -> DataFrame:
    return spark.createDataFrame([(c, i) for i, c in enumerate(crawl_names(crawls))],
                                 "crawl string, crawl_rank int")


_SCHEME_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/]*)?"


def _bare_prefix(path: str) -> str:
    import re
    for i, ch in enumerate(path):
        if ch in "*?[{":
            path = path[:i]
            break
    return re.sub(_SCHEME_AUTHORITY, "", path)


def _crawl_depth(template: str, base: str) -> int | None:
    """Place of the crawl's folder in an absolute path, where it is a folder of its own."""
    import re
    bare = re.sub(_SCHEME_AUTHORITY, "", template.format(base=base, crawl="\0"))
    parts = [x for x in bare.split("/") if x]
    return parts.index("\0") if bare.startswith("/") and parts.count("\0") == 1 else None


def _tagged(spark: SparkSession, crawls, template: str, base: str, sep: str = "tab") -> DataFrame:
    """One read over every crawl's index, each row tagged (crawl, crawl_rank)."""
    pairs = [(c, i, template.format(base=base, crawl=c)) for i, c in enumerate(crawl_names(crawls))]
    paths = [p for _, _, p in pairs]
    raw = _read_raw(spark, paths, sep)
    depth = _crawl_depth(template, base)
    if depth is not None:       # the crawl is a folder: an equi-join on its name
        parts = F.split(F.col("_file"), "/")
        # scheme and authority are the first three parts of scheme://authority/..., else the scheme alone
        name = F.get(parts, F.when(F.contains("_file", F.lit("://")), 3).otherwise(1) + depth)
        named = spark.createDataFrame([(c, r) for c, r, _ in pairs], "crawl string, crawl_rank int")
        return raw.withColumn("crawl", name).drop("_file").join(named, "crawl")
    # Otherwise map file -> crawl by prefix with a tiny broadcast table (one row
    # per crawl named by the caller, so its size is bounded by the argument list).
    # Both sides are compared as bare paths (no scheme, no authority), and a
    # template prefix ends at its first glob character.
    prefixes = spark.createDataFrame(
        [(c, r, _bare_prefix(p).rstrip("/"), not any(ch in p for ch in "*?[{")) for c, r, p in pairs],
        "crawl string, crawl_rank int, _prefix string, _whole boolean")
    bare = F.regexp_replace(F.col("_file"), _SCHEME_AUTHORITY, "")
    at_boundary = ((F.length(bare) == F.length("_prefix"))
                   | (F.substring(bare, F.length("_prefix") + 1, 1) == F.lit("/")))
    cond = F.startswith(bare, F.col("_prefix")) & (~F.col("_whole") | at_boundary)
    return raw.join(F.broadcast(prefixes), cond).drop("_file", "_prefix", "_whole")


def read_block_index(spark: SparkSession, crawls, template: str = DEFAULT_INDEX_TEMPLATE,
                     base: str = "", max_blocks: int | None = None, sep: str = "tab") -> DataFrame:
    """S1 + S7 (+ S8): typed index rows of every named crawl.

    ``max_blocks`` keeps blocks with id <= n before any fetch (S8); it is a
    predicate on the index, not an unordered ``limit``; rows without an id
    have no place in that order and are left out.
    """
    typed = _typed(_tagged(spark, crawls, template, base, sep)).where(_valid())
    if max_blocks is not None:
        typed = typed.where(F.col("block_id").between(0, F.lit(max_blocks)))
    return typed.select("crawl", "crawl_rank", "start_key", "start_ts", "cdx_filename",
                        "cdx_offset", "cdx_length", "block_id")


def block_index_rejects(spark: SparkSession, crawls, template: str = DEFAULT_INDEX_TEMPLATE,
                        base: str = "") -> DataFrame:
    """Index rows that cannot be used, with a reason."""
    typed = _typed(_tagged(spark, crawls, template, base))
    return (typed.where(~_valid())
                 .select("crawl", F.concat_ws("\t", "c0", "c1", "c2", "c3", "c4").alias("raw"),
                         _reject_reason().alias("reason")))


# --- S6 ------------------------------------------------------------------------------

def explode_batch_messages(messages: DataFrame, body: str = "body",
                           keep=("run_id", "crawl", "batch_no")) -> DataFrame:
    """One row per entry of each JSON-array batch message."""
    keep = [c for c in keep if c in messages.columns]
    arr = F.from_json(F.col(body), BATCH_MESSAGE)
    return (messages.select(*keep, F.posexplode(arr).alias("item_no", "entry"))
                    .select(*keep, F.col("item_no").cast("int"), "entry.surt_url", "entry.timestamp",
                            "entry.metadata"))
