"""A training-corpus pipeline over `documents`, in five stages.

Each stage is a Spark job over all rows that its predecessor kept; its result is
written as Parquet in the shared folder and read again as the next one's input,
so a lost executor costs tasks, not stages.

Defined cases: as each operator states; other columns of the table pass through
every stage but the last unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsieve.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from crawlsieve.llm.common import shared_folder, stored, table
from crawlsieve.llm.encode import tokenizer_file
from crawlsieve.session import apply_defaults

MIX_REPETITION = 2.0     # no source's documents appear more than twice on average


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` written with a row number, under a name that no column has."""
    name = "_row"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def _without(docs: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    return docs.join(dropped, row, "left_anti").drop(row)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the factorization machine does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts equal but for blanks."""
    rows, name = _numbered(docs)
    return _without(rows, name, exact_dedup.exact_copies(rows, name))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies."""
    rows, name = _numbered(docs)
    return _without(rows, name, ngram_join.near_copies(rows, name))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row once or more often, as the mixture of sources takes it."""
    return mixing.mixed(docs, max_repetition=MIX_REPETITION)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows and their places in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file())


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("ngram_join", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_sequences)]

ORACLE_SQL = None   # learned scores and token ids; tested against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    apply_defaults(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
