"""Registered queries of this subpackage and the SQL of those that have one."""

from __future__ import annotations

from crawlsieve.llm import (  # noqa: F401 - registers
    alignment, centroids, chat_format, exact_dedup, language_model, minhash, mixing, ngram_join, packing, prefix_counts, token_planes, toxicity, url_filter)
from crawlsieve.llm.common import ORACLE, QUERIES  # noqa: F401
