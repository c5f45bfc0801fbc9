"""crawlsieve: web-crawl archives to a clean text corpus, as Spark jobs.

Modules: ``sources`` (block index, ranged block and archive reads, sinks),
``functions`` (column expressions for CDX lines and text), ``operators``
(dedup, batching, extraction, tokenization, metrics, run ledger),
``plans`` (stage jobs, registered queries and their SQL oracle) and
``streaming`` (the worker and dedup as Structured Streaming queries).
"""

__version__ = "0.1.0"
