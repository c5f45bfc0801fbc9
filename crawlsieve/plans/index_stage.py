"""Index stage (the "batcher"): lines -> parsed -> filtered -> deduped -> batches.

Plan shape: scan -> narrow parse/filter (one codegen span) -> dedup
shuffle on the URL key -> batch numbering (bounded windows) -> write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from crawlsieve.functions.cdx import parse_cdx_line, with_outcome
from crawlsieve.operators.batching import batch_fixed_size
from crawlsieve.operators.dedup import dedup_first_seen

LINEAGE = ("crawl", "crawl_rank", "block_id", "line_no")


def parsed_lines(lines: DataFrame, squash_spaces: bool = False, language: str = "eng",
                 match: str = "token", status_mode: str = "string") -> DataFrame:
    """Parse every line and label its funnel outcome."""
    df = parse_cdx_line(lines, "line", squash_spaces=squash_spaces)
    return with_outcome(df, language=language, match=match, status_mode=status_mode)


def kept_entries(lines: DataFrame, dedup: bool = True, **kw) -> DataFrame:
    """Entries that pass the filters and, when ``dedup``, win D1."""
    df = parsed_lines(lines, **kw).where("outcome = 'pass'").drop("outcome")
    df = df.select(*LINEAGE, "surt_url", "timestamp", "metadata")
    return dedup_first_seen(df) if dedup else df


def index_batches(lines: DataFrame, batch_size: int = 50, dedup: bool = True, **kw) -> DataFrame:
    """Kept entries numbered into fixed-size batches per crawl (B1)."""
    return batch_fixed_size(kept_entries(lines, dedup=dedup, **kw), batch_size)
