"""Mixing sources to target weights by temperature (operator 2).

Source weights are token shares raised to an exponent in 0..1 and normalised: 1 keeps
the shares, 0 makes all sources equal.  The exponent is bisected on a grid of 2^-20:
the largest one whose weights reach `target_entropy` (a share of the greatest
entropy, ln of the number of sources), or, if that would repeat a source's documents
more than `max_repetition` times, the least one that keeps this limit.  The total budget lets the
largest source pass exactly once, so every document appears at least once and
smaller sources repeat.

A source's budget is realised in passes: whole passes, then part of one.  For the last
pass the source's documents lie in 1,024 blocks of 1,024 sub-blocks (by hash of the
id), and blocks, sub-blocks and documents are put in an order permuted per source and
pass; documents are taken in that order while their tokens fit.

Scale: the bisection is a few aggregations over the table of sources, which never
leaves Spark; each evaluates 32 exponents at once.  The last pass's cut is found by
prefix sums over at most 1,024 blocks, then 1,024 sub-blocks, then one sub-block's
documents per source.  Whether a document is taken is then a comparison with its
source's cut, so texts are neither sorted nor grouped; the cuts are joined by
source, which Spark broadcasts only if they are small and splits if hot.

Defined cases: tokens are words; a null text has none; a null source is the source
named ''; a source without tokens passes once; repeated rows count and are taken alike;
documents with equal ids are taken together; an empty table has no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlsieve.llm.common import register, stored, table

GRID = 1 << 20
SECTIONS = 32
BLOCKS = 1024
TARGET_ENTROPY = 0.9995
MAX_REPETITION = 4.0
SEED = "mix-1"
WORDS = r"[^\x20\x09-\x0D]+"


def n_tokens(text) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORDS)).cast("long")


def source_name(source) -> Column:
    return F.coalesce(source.cast("string"), F.lit(""))


def _doc_hash(doc_id) -> Column:
    return F.md5(F.concat(F.lit(f"{SEED}|"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _block(digest, level: int) -> Column:
    return (F.conv(F.substring(digest, 1 + 8 * level, 8), 16, 10).cast("long") % BLOCKS).cast("string")


def _permuted(level: str, source, nth_pass, block) -> Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), F.lit(level), nth_pass.cast("string"), source, block).cast("binary"))


def order_keys(doc_id, source, nth_pass) -> list[Column]:
    """Block, sub-block and document key of a document in a pass over its source."""
    digest = _doc_hash(doc_id)
    return [_permuted("block", source, nth_pass, _block(digest, 0)),
            _permuted("part", source, nth_pass, _block(digest, 1)), digest]


def _search(shares: DataFrame, holds, ascending: bool) -> int:
    """Bisection in SECTIONS parts a step: with `ascending` the least grid number that
    holds, else the greatest; `holds` maps a list of exponents to aggregate columns.
    GRID if none does (ascending), 0 likewise (descending)."""
    low, high = 0, GRID       # the answer lies in low..high
    while low < high:
        step = max(1, -(-(high - low) // SECTIONS))
        tried = sorted({min(high, low + i * step) for i in range(SECTIONS + 1)})
        row = shares.agg(*(c.alias(f"h{i}") for i, c in enumerate(holds([t / GRID for t in tried])))).first()
        good = [t for i, t in enumerate(tried) if row[f"h{i}"]]
        if ascending:
            if not good:
                return GRID
            high = good[0]
            low = max([t + 1 for t in tried if t < high], default=low)
        else:
            if not good:
                return 0
            low = good[-1]
            high = min([t - 1 for t in tried if t > low], default=high)
    return low


def solve_exponent(totals: DataFrame, target_entropy: float = TARGET_ENTROPY,
                   max_repetition: float = MAX_REPETITION) -> float:
    """The exponent for a table (source, tokens)."""
    full = totals.where("tokens > 0")
    seen = full.agg(F.count("*").alias("n"), F.max("tokens").alias("most"), F.min("tokens").alias("least")).first()
    if not seen["n"]:
        return 1.0
    shares = full.select((F.col("tokens") / float(seen["most"])).alias("s"))
    goal = target_entropy * math.log(seen["n"])

    def spread(exponents):
        out = []
        for a in exponents:
            z = F.sum(F.pow("s", F.lit(a)))
            e = F.sum(F.pow("s", F.lit(a)) * F.log("s"))
            out.append(F.log(z) - F.lit(a) * e / z >= goal)
        return out

    by_entropy = _search(shares, spread, ascending=False)
    ratio = float(seen["most"]) / float(seen["least"])
    by_limit = _search(shares, lambda xs: [F.max(F.lit(math.pow(ratio, 1.0 - a) <= max_repetition)) for a in xs],
                       ascending=True)
    return max(by_entropy, by_limit) / GRID


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
         target_entropy: float = TARGET_ENTROPY, max_repetition: float = MAX_REPETITION) -> tuple[DataFrame, DataFrame]:
    """(documents, sources): the documents' numbers without texts, and per source the
    tokens, weight, budget, whole passes and the cut of the last one."""
    numbers = stored(docs.select(F.col(key).cast("long").alias("doc_id"), source_name(F.col(source)).alias("source"),
                                 n_tokens(F.col(text)).alias("n_tokens")), "numbers")
    totals = stored(numbers.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "totals")
    exponent = solve_exponent(totals, target_entropy, max_repetition)
    most = totals.agg(F.max("tokens")).first()[0] or 0
    scaled = F.pow(F.col("tokens") / float(max(1, most)), F.lit(exponent))
    norm = totals.where("tokens > 0").agg(F.sum(scaled)).first()[0] or 1.0
    budget = F.greatest(F.floor(most * scaled).cast("long"), F.col("tokens"))
    sources = (totals.withColumn("budget", F.when(F.col("tokens") > 0, budget).otherwise(F.lit(0).cast("long")))
               .withColumn("weight", F.when(F.col("tokens") > 0, scaled / norm).otherwise(0.0))
               .withColumn("passes", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(1).cast("long")))
               .withColumn("part", F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(F.lit(0).cast("long"))))
    sources = stored(sources, "sources")
    return numbers, stored(_cuts(numbers, sources), "cuts")


def _cuts(numbers: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds (c1, c2, c3, c_id): the last document of the last pass, in pass order."""
    k1, k2, k3 = order_keys(F.col("doc_id"), F.col("source"), F.col("passes"))
    left = numbers.join(sources.select("source", "passes", "part"), "source").select(
        "source", "part", "doc_id", "n_tokens", k1.alias("k1"), k2.alias("k2"), k3.alias("k3"))

    def cut(rows: DataFrame, key: str) -> DataFrame:
        """The first group, in key order, that does not fit whole; `room` is left for it."""
        upto = Window.partitionBy("source").orderBy(key)
        sums = rows.groupBy("source", "part", key).agg(F.sum("n_tokens").alias("n"))
        sums = sums.withColumn("upto", F.sum("n").over(upto)).where("upto > part")
        first = sums.groupBy("source").agg(F.min(F.struct(key, "upto", "n", "part")).alias("f"))
        return first.select("source", F.col(f"f.{key}").alias(key), (F.col("f.part") - F.col("f.upto") + F.col("f.n")).alias("part"))

    c1 = stored(cut(left, "k1"), "blocks")
    inside = left.drop("part").join(c1, ["source", "k1"])
    c2 = stored(cut(inside, "k2"), "parts")
    last = inside.drop("part").join(c2, ["source", "k2"])
    ends = (last.withColumn("order", F.struct("k3", "doc_id")).withColumn(
        "upto", F.sum("n_tokens").over(Window.partitionBy("source").orderBy("order")
                                       .rangeBetween(Window.unboundedPreceding, Window.currentRow)))
        .where("upto <= part").groupBy("source").agg(F.max("order").alias("end")))
    return (sources.join(c1.select("source", F.col("k1").alias("c1")), "source", "left")
            .join(c2.select("source", F.col("k2").alias("c2")), "source", "left").join(ends, "source", "left")
            .select(*sources.columns, "c1", "c2", F.coalesce("end.k3", F.lit("")).alias("c3"),
                    F.col("end.doc_id").alias("c_id")))


_CUT = ("source_name", "passes", "c1", "c2", "c3", "c_id")


def _copies(doc_id, cut) -> Column:
    """Copies of a document, given its source's cut as a struct."""
    k1, k2, k3 = order_keys(doc_id, cut["source_name"], cut["passes"])
    taken = (F.struct(k1.alias("a"), k2.alias("b"), k3.alias("c"), doc_id.cast("long").alias("d"))
             <= F.struct(cut["c1"].alias("a"), cut["c2"].alias("b"), cut["c3"].alias("c"), cut["c_id"].alias("d")))
    return cut["passes"] + F.when(cut["c1"].isNotNull() & taken, 1).otherwise(0)


def copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
           target_entropy: float = TARGET_ENTROPY, max_repetition: float = MAX_REPETITION) -> DataFrame:
    """doc_id, source, n_tokens, weight of the source, and copies per row."""
    numbers, sources = plan(docs, key, text, source, target_entropy, max_repetition)
    named = sources.withColumnRenamed("source", "source_name")
    joined = numbers.join(named, F.col("source") == F.col("source_name"))
    return joined.select(F.col("doc_id").alias(key), F.col("source").alias(source), "n_tokens",
                         F.round("weight", 9).alias("weight"), _copies(F.col("doc_id"), F.struct(*_CUT)).alias("copies"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          target_entropy: float = TARGET_ENTROPY, max_repetition: float = MAX_REPETITION) -> DataFrame:
    """The rows of `docs`, all columns, each as often as the mixture takes it."""
    _, sources = plan(docs, key, text, source, target_entropy, max_repetition)
    named = sources.withColumnRenamed("source", "source_name").select(
        F.struct(*_CUT).alias("_cut"), F.col("source_name").alias("_source"))
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    joined = held.join(named, source_name(F.col("_row").getField(source)) == F.col("_source"))
    times = _copies(F.col("_row").getField(key), F.col("_cut"))
    return (joined.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("_copy")).select("_row.*"))


def oracle(target_entropy: float = TARGET_ENTROPY, max_repetition: float = MAX_REPETITION) -> str:
    """The same mixture in DuckDB SQL, with whole-source windows."""
    block = "(('0x' || substr(h, {at}, 8))::BIGINT % 1024)::VARCHAR"
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS n_tokens,
         md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
t AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY source),
m AS (SELECT max(tokens) AS most, min(tokens) AS least, count(*) AS n,
             list(tokens::DOUBLE / (SELECT max(tokens) FROM t)) AS s FROM t WHERE tokens > 0),
e AS (
  SELECT 0 AS lo, {GRID} AS hi
  UNION ALL
  SELECT CASE WHEN good THEN mid ELSE lo END, CASE WHEN good THEN hi ELSE mid - 1 END
  FROM (SELECT lo, hi, (lo + hi + 1) // 2 AS mid,
               ln(list_sum([pow(x, ((lo + hi + 1) // 2) / {GRID}.0) for x in s]))
               - ((lo + hi + 1) // 2) / {GRID}.0 * list_sum([pow(x, ((lo + hi + 1) // 2) / {GRID}.0) * ln(x) for x in s])
                 / list_sum([pow(x, ((lo + hi + 1) // 2) / {GRID}.0) for x in s]) >= {target_entropy} * ln(n) AS good
        FROM e, m WHERE lo < hi)),
r AS (
  SELECT 0 AS lo, {GRID} AS hi
  UNION ALL
  SELECT CASE WHEN good THEN lo ELSE mid + 1 END, CASE WHEN good THEN mid ELSE hi END
  FROM (SELECT lo, hi, (lo + hi) // 2 AS mid,
               pow(most::DOUBLE / least, 1.0 - ((lo + hi) // 2) / {GRID}.0) <= {max_repetition} AS good
        FROM r, m WHERE lo < hi)),
a AS (SELECT greatest((SELECT lo FROM e WHERE lo = hi), (SELECT lo FROM r WHERE lo = hi)) / {GRID}.0 AS exponent),
w AS (SELECT t.*, pow(tokens::DOUBLE / most, exponent) AS scaled, most FROM t, m, a),
b AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN round(scaled / (SELECT sum(scaled) FROM w WHERE tokens > 0), 9) ELSE 0 END AS weight,
         CASE WHEN tokens > 0 THEN greatest(floor(most * scaled)::BIGINT, tokens) // tokens ELSE 1 END AS passes,
         CASE WHEN tokens > 0 THEN greatest(floor(most * scaled)::BIGINT, tokens) % tokens END AS part
  FROM w),
k AS (
  SELECT doc_id, d.source, n_tokens, weight, passes, part, h,
         md5(concat_ws('|', '{SEED}', 'block', passes::VARCHAR, d.source, {block.format(at=1)})) AS k1,
         md5(concat_ws('|', '{SEED}', 'part', passes::VARCHAR, d.source, {block.format(at=9)})) AS k2
  FROM d JOIN b ON d.source = b.source)
SELECT doc_id, source, n_tokens, weight,
       passes + CASE WHEN sum(n_tokens) OVER (PARTITION BY source ORDER BY k1, k2, h, doc_id) <= part THEN 1 ELSE 0 END AS copies
FROM k
"""


@register("op2_temperature_mixing", oracle())
def op2_temperature_mixing(spark, sf_dir):
    """How often the mixture takes each row of `documents`."""
    return copies(table(spark, sf_dir, "documents"))
