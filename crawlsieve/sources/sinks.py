"""Sinks (K1, K2).

K1 writes the 7-column document record as gzip Parquet under
``year=YYYY/month=MM/day=DD`` (three partition columns, so no ``/`` ends
up inside a partition value).  Partition values are read back as strings
by passing an explicit schema (``'07'`` stays ``'07'``).  A failed write
fails the job: nothing is silently lost.

K2 writes batch messages partitioned by crawl; the same folder is the
file source of the streaming worker (T1).
"""

from __future__ import annotations

import uuid

from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsieve.files import claim, exists, folder_keys, open_path, put_whole, qualify, remove
from crawlsieve.schemas import DOCUMENT
from crawlsieve.sources.ranged import work_partitions

DATE_PARTS = ("year", "month", "day")


def with_date_parts(df: DataFrame, ts: str | None = "timestamp") -> DataFrame:
    """Partition columns from a ``yyyyMMdd...`` capture timestamp, or from
    the processing date when ``ts`` is None (the reference's choice)."""
    if ts is None:
        d = F.date_format(F.current_date(), "yyyyMMdd")
    else:
        d = F.substring(F.col(ts), 1, 8)
    return (df.withColumn("year", F.substring(d, 1, 4))
              .withColumn("month", F.substring(d, 5, 2))
              .withColumn("day", F.substring(d, 7, 2)))


def by_day(df: DataFrame, date_from: str | None = "timestamp") -> DataFrame:
    """Rows brought together by partition day; Spark splits the large days, so
    a day is few files and no file is unbounded."""
    return with_date_parts(df, date_from).hint("rebalance", *DATE_PARTS).drop(*DATE_PARTS)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"     # the folder of a null, as Spark names it
ESCAPED = frozenset([*map(chr, range(1, 32)), "\x7f", *"\"#%'*/:=?\\{[]^"])
ROW_GROUP_BYTES = 32 * 1024 * 1024


def partition_folder(key: str, value: str | None) -> str:
    """The folder of a partition value, named and escaped as Spark does."""
    return f"{key}=" + ("".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value) if value else NO_VALUE)


def _to_files(root: str, keys: list[str], name: str):
    """Rows sorted by the (text) columns ``keys`` -> one gzip Parquet file per group of
    equal keys, at most ``ROW_GROUP_BYTES`` of it in memory; yields nothing."""
    def pieces(batches):
        for b in batches:
            rows = list(zip(*(b.column(k).to_pylist() for k in keys)))
            data, at = b.drop_columns(keys), 0
            for key, same in groupby(rows):
                n = sum(1 for _ in same)
                yield key, data.slice(at, n)
                at += n

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        system, top = open_path(root)

        def fill(out, group):
            held = [next(group)]
            # the level that Spark's own gzip Parquet has
            with pq.ParquetWriter(out, held[0].schema, compression="gzip", compression_level=6, store_schema=False) as writer:
                size = held[0].nbytes
                for piece in group:
                    if size >= ROW_GROUP_BYTES:
                        writer.write_table(pa.Table.from_batches(held))
                        held, size = [], 0
                    held.append(piece)
                    size += piece.nbytes
                writer.write_table(pa.Table.from_batches(held))

        for key, group in groupby(pieces(batches), key=lambda p: p[0]):
            folder = "/".join(partition_folder(k, v) for k, v in zip(keys, key))
            put_whole(system, f"{top}/{folder}/{name}", lambda out: fill(out, (piece for _, piece in group)))
        yield from ()

    return run


def write_uploads(df: DataFrame, path: str, batch: str = "upload_batch_no", above=(), mode: str = "append") -> None:
    """K1 with thresholds: ``df`` has date parts and the number of its upload batch.
    The number is a physical key: a batch goes to one task, which writes it as one
    file in a folder of its own, so no file exceeds what closes a batch by more than
    a document.  ``above``: columns whose folders lie above the date.

    Batches can be few documents, so what a file costs counts: tasks write the files
    themselves (Spark's writer asks the file system for rights and checksums of each, on
    local disks by two other processes), in as many tasks as there are slots, however
    few bytes they are.  A task that runs again writes the same names.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', got {mode!r}")
    spark, keys = df.sparkSession, [*above, *DATE_PARTS, batch]
    rest = [c for c in df.columns if c not in keys]
    dealt = (df.select(*rest, *[F.col(k).cast("string").alias(k) for k in keys])
             .repartition(work_partitions(spark), *keys).sortWithinPartitions(*keys))
    if mode == "overwrite":
        remove(spark, path)
    run = _to_files(qualify(spark, path).rstrip("/"), keys, f"part-{uuid.uuid4().hex}.gz.parquet")
    try:
        dealt.mapInArrow(run, "written boolean").write.format("noop").mode("overwrite").save()
    except Exception:
        if mode == "overwrite":
            remove(spark, path)
        raise
    claim(spark, f"{path}/_SUCCESS", "")        # also the folder, where there was no row


def write_documents(df: DataFrame, path: str, date_from: str | None = "timestamp",
                    max_records_per_file: int = 10000, mode: str = "append", above=()) -> None:
    """K1: gzip Parquet, partitioned by date (below the folders of ``above``);
    empty input writes nothing."""
    out = with_date_parts(df, date_from)
    (out.write.mode(mode).partitionBy(*above, *DATE_PARTS)
        .option("compression", "gzip").option("maxRecordsPerFile", max_records_per_file)
        .parquet(path))


ORIGIN = ("source_run", "crawl")     # what a document came from: stage-1 run and crawl


FOLDER_TYPES = {"lane": "int", "upload_batch_no": "int"}     # any other folder is text


def _folder_value(file: Column, key: str) -> Column:
    """What a file's folder says about ``key``: the URL of the file and the name of the
    folder are both escaped; null where it names no value or there is no such folder."""
    def unescaped(c: Column) -> Column:
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))       # a plus is a plus in both

    name = F.regexp_extract(file, f".*/{key}=([^/]*)/", 1)
    return F.when(~name.isin("", NO_VALUE), unescaped(unescaped(name))).cast(FOLDER_TYPES.get(key, "string"))


def read_documents(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT, runs: bool = False,
                   run: str = "run_id", only: list[str] | None = None) -> DataFrame:
    """Documents below a folder; ``runs``: with the run folder they lie in and
    their origin.  ``only``: the runs to read; no other folder is listed.

    Files are listed and their folders' values taken from their names, a row at a time.
    Spark's own discovery of partitions is quadratic in their number (28,000 folders
    12.8 s, 112,000 folders 217.9 s), and every upload batch is one."""
    parts = [*((run, *ORIGIN) if runs else ()), *DATE_PARTS]
    parts += [k for k in folder_keys(spark, path) if k not in parts and k not in schema.names]
    folders = [path] if only is None else [f"{path}/{partition_folder(run, r)}" for r in only]
    folders = [f for f in folders if only is None or exists(spark, f)]
    docs = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*(folders or [path]))
    docs = docs.select("*", *[_folder_value(F.col("_metadata.file_path"), k).alias(k) for k in parts])
    return docs if folders else docs.where(F.lit(False))


BATCH_ROW = T.StructType([
    T.StructField("batch_no", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("body", T.StringType()),
    T.StructField("crawl", T.StringType()),
    T.StructField("run_id", T.StringType()),   # partition folder of a stage-1 run; null elsewhere
])


def write_batches(messages: DataFrame, path: str, mode: str = "append", fmt: str = "json") -> None:
    """K2: one row per batch message (JSON lines or Parquet), partitioned by crawl."""
    (messages.select("crawl", "batch_no", "n", "body").write.mode(mode).partitionBy("crawl")
             .format(fmt).save(path))


def read_batches(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(BATCH_ROW).format(fmt).load(path)
