"""URL filter by a weighted vocabulary (operator 1).

An Aho-Corasick automaton finds every strict and soft term of a lower-cased
URL in one pass.  A hit counts only between boundaries (start, end or a
character outside [a-z0-9]).  One strict term rejects a URL, and so do
`soft_limit` or more *distinct* soft terms.

Host and path rules come before the vocabulary: a rule fits its host and all
subdomains if the URL's path starts with the rule's path; the longest fitting
rule decides.

The automaton is built once per task from the argument lists.  No shuffle; every
task streams its rows, so memory is one Arrow batch.

Defined cases: a null URL, or one without `://`, has an empty host and path,
no rule, and is judged by the vocabulary alone (null: allow).  Repeated rows
are judged one by one; an empty table gives an empty result; other columns of
the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsieve.llm.common import register, table

# Production vocabulary.  Strict terms reject alone, soft terms together.
STRICT = ("casino", "escort", "jackpot", "payday-loans", "porn", "porno", "sexcam",
          "spam-farm", "cheap-pills", "viagra", "warez", "xxx")
SOFT = ("adult", "bet", "bonus", "cheap", "cracked", "deal", "dating", "download", "farm", "free",
        "gambling", "hot", "loan", "lottery", "nude", "pills", "poker", "promo", "replica",
        "sex", "spam", "torrent", "win")
SOFT_LIMIT = 2

# (action, host, path prefix), as the contract of the query states them
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def _check_terms(terms: Iterable[str]) -> None:
    for t in terms:
        if not t or t != t.lower():
            raise ValueError(f"vocabulary terms are lower-case and not empty: {t!r}")


@dataclass
class Vocabulary:
    """The automaton over strict and soft terms."""
    strict: tuple[str, ...] = STRICT
    soft: tuple[str, ...] = SOFT
    soft_limit: int = SOFT_LIMIT
    _automaton: object = field(default=None, repr=False)

    def __post_init__(self) -> None:
        import ahocorasick
        _check_terms([*self.strict, *self.soft])
        self._automaton = ahocorasick.Automaton()
        for t in {*self.strict, *self.soft}:
            self._automaton.add_word(t, (t, t in self.strict))
        if len(self._automaton):
            self._automaton.make_automaton()

    def hits(self, url: str) -> tuple[int, int]:
        """(distinct strict terms, distinct soft terms) between boundaries."""
        if not len(self._automaton):
            return 0, 0
        # only A-Z are lower-cased, as for the host
        s = url.translate(_LOWER)
        strict, soft = set(), set()
        for end, (term, is_strict) in self._automaton.iter(s):
            start = end + 1 - len(term)
            if (start == 0 or s[start - 1] not in _INSIDE) and (end + 1 == len(s) or s[end + 1] not in _INSIDE):
                (strict if is_strict else soft).add(term)
        return len(strict), len(soft)


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_INSIDE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def host_and_path(url):
    """Native columns (host, path) of a URL column."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_columns(host, path, rules=RULES):
    """Native columns (action, rule) of the longest rule that fits; else null."""
    action = rule = F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        action = F.when(fits, F.lit(act)).otherwise(action)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
    return action, rule


def judge_urls(pages: DataFrame, url: str = "url", key: str = "page_id", rules=RULES, strict=STRICT,
               soft=SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """key, host, path, rule, verdict, strict_hits, soft_hits per row."""
    _check_terms([*strict, *soft])
    host, path = host_and_path(F.col(url))
    action, rule = rule_columns(F.col("host"), F.col("path"), rules)
    rows = (pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
            .select("key", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(tuple(strict), tuple(soft), soft_limit)
        for batch in batches:
            found = [vocabulary.hits(u) for u in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3),
                 pa.array([s for s, _ in found], pa.int32()), pa.array([s for _, s in found], pa.int32())],
                names=["key", "host", "path", "strict_hits", "soft_hits"])

    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"key {kind}, host string, path string, strict_hits int, soft_hits int")
    method = F.when((F.col("strict_hits") >= 1) | (F.col("soft_hits") >= soft_limit), "block").otherwise("allow")
    return counted.select(F.col("key").alias(key), "host", "path", rule.alias("rule"),
                          F.coalesce(action, method).alias("verdict"), "strict_hits", "soft_hits")


def _sql_hits(terms) -> str:
    return " + ".join(f"(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)'))::INT" for t in terms)


_SQL_RULES = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
_FITS = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in _SQL_RULES]
ORACLE = f"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
h AS (
  SELECT *, {_sql_hits(STRICT)} AS strict_hits, {_sql_hits(SOFT)} AS soft_hits,
         CASE {' '.join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(_FITS, _SQL_RULES))} END AS rule,
         CASE {' '.join(f"WHEN {f} THEN '{a}'" for f, (a, _, _) in zip(_FITS, _SQL_RULES))} END AS action
  FROM p)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN strict_hits >= 1 OR soft_hits >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       strict_hits, soft_hits
FROM h
"""


@register("op1_url_filter", ORACLE)
def op1_url_filter(spark, sf_dir):
    """Every URL of `pages`: host, path, rule and verdict."""
    return judge_urls(table(spark, sf_dir, "pages"))
