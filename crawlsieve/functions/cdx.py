"""Column expressions for CDX index lines: parsing, typing and filters.

All of these are native Catalyst expressions (no Python worker).  They
compose into a single whole-stage-codegen span after the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlsieve.schemas import CRAWL_PREFIX, METADATA_MAP

# Whitespace as Go's unicode.IsSpace / Java's (?U)\s define it, spelled out so
# that the same class is valid in both Java regex and RE2 (fixed values).
UNICODE_SPACE_CLASS = (
    "[\\t\\n\\x{0B}\\f\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)

_JSON_OPTIONS = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P1: line parse -------------------------------------------------------

def parse_cdx_line(df: DataFrame, line: str = "line", squash_spaces: bool = False) -> DataFrame:
    """Split ``surt SP timestamp SP json`` into surt_url, timestamp, metadata.

    ``metadata`` is a ``map<string,string>``; it is NULL when the line does
    not have three parts or the JSON part is not an object (parse error).
    ``squash_spaces`` reproduces the variant that deletes every space of the
    JSON text before decoding.
    """
    parts = F.split(_c(line), " ", 3)
    js = F.get(parts, 2)
    if squash_spaces:
        js = F.replace(js, F.lit(" "), F.lit(""))
    out = df.withColumn("surt_url", F.get(parts, 0)).withColumn("timestamp", F.get(parts, 1))
    # The map is produced by a one-element explode so that the outcome
    # predicates (pushed below a plain projection they would each re-run
    # from_json) read the decoded map instead: JSON is parsed once per line.
    return out.select("*", F.explode(F.array(F.from_json(js, METADATA_MAP, _JSON_OPTIONS))).alias("metadata"))


def meta(key: str, metadata: str = "metadata") -> Column:
    """Value of ``key``; with duplicate JSON keys the last one wins (as a
    JSON object decoder does), not the first map entry."""
    vals = F.map_values(F.map_filter(F.col(metadata), lambda k, v: k == F.lit(key)))
    return F.try_element_at(vals, F.lit(-1))


# --- P2: typed metadata projection ---------------------------------------

def typed_metadata(df: DataFrame, metadata: str = "metadata") -> DataFrame:
    """The six fixed fields, integers parsed from their string form."""
    return df.select(
        *[c for c in df.columns if c != metadata],
        meta("url", metadata).alias("url"),
        meta("status", metadata).try_cast("int").alias("status"),
        meta("length", metadata).try_cast("bigint").alias("length"),
        meta("offset", metadata).try_cast("bigint").alias("offset"),
        meta("filename", metadata).alias("filename"),
        meta("languages", metadata).alias("languages"),
    )


# --- P3: SURT key normalisation -----------------------------------------

def normalize_surt(c) -> Column:
    """First whitespace token when the key holds a space, else unchanged."""
    c = _c(c)
    return F.when(F.contains(c, F.lit(" ")),
                  F.get(F.split(F.trim(c), "(?U)\\s+"), 0)).otherwise(c)


# --- F1/F2: language --------------------------------------------------------

def language_contains(language: str = "eng", metadata: str = "metadata") -> Column:
    """Keep iff ``languages`` is present and contains the code as substring."""
    return F.coalesce(F.contains(meta("languages", metadata), F.lit(language)), F.lit(False))


def language_token(language: str = "eng", metadata: str = "metadata") -> Column:
    """Keep iff one comma-separated, trimmed token equals the code."""
    toks = F.split(meta("languages", metadata), ",")
    return F.coalesce(F.exists(toks, lambda x: F.trim(x) == F.lit(language)), F.lit(False))


def language_ok(language: str = "eng", match: str = "token", metadata: str = "metadata") -> Column:
    if match == "token":
        return language_token(language, metadata)
    if match == "contains":
        return language_contains(language, metadata)
    raise ValueError(f"match must be 'token' or 'contains', got {match!r}")


# --- F3/F4: status ----------------------------------------------------------

def status_string_ok(status: str = "200", metadata: str = "metadata") -> Column:
    return F.coalesce(meta("status", metadata) == F.lit(status), F.lit(False))


def status_numeric_ok(status: int = 200, metadata: str = "metadata") -> Column:
    return F.coalesce(meta("status", metadata).try_cast("int") == F.lit(status), F.lit(False))


# --- F5 + outcome column -----------------------------------------------------

def index_outcome(language: str = "eng", match: str = "token", status_mode: str = "string",
                  metadata: str = "metadata") -> Column:
    """Funnel outcome in the reference's filter order:
    parse_error, then language, then status, else pass."""
    st = status_string_ok("200", metadata) if status_mode == "string" else status_numeric_ok(200, metadata)
    return (F.when(F.col(metadata).isNull(), F.lit("parse_error"))
             .when(~language_ok(language, match, metadata), F.lit("language"))
             .when(~st, F.lit("status"))
             .otherwise(F.lit("pass")))


def with_outcome(df: DataFrame, **kw) -> DataFrame:
    return df.withColumn("outcome", index_outcome(**kw))


def index_filter(df: DataFrame, **kw) -> DataFrame:
    """Rows that pass parse, language and status checks."""
    return with_outcome(df, **kw).where(F.col("outcome") == "pass").drop("outcome")


# --- F9: crawl names ---------------------------------------------------------

def crawl_name_ok(c) -> Column:
    return F.startswith(F.trim(_c(c)), F.lit(CRAWL_PREFIX))


def parse_crawl_versions(spec: str) -> list[str]:
    """Comma list -> stripped names with the crawl prefix, in given order.

    Duplicates are collapsed (first position wins); an empty result is an
    error.  This is argument handling on the driver, not data work.
    """
    import warnings

    out: list[str] = []
    for v in (spec or "").split(","):
        v = v.strip()
        if v and not v.startswith(CRAWL_PREFIX):
            warnings.warn(f"ignoring crawl version without the {CRAWL_PREFIX} prefix: {v!r}")
        elif v and v not in out:
            out.append(v)
    if not out:
        raise ValueError(f"no valid crawl versions in {spec!r}")
    return out
