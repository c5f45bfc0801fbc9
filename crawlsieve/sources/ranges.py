"""Which ranges are read together, and by which task.

Ranges of one file that touch or nearly touch are one request (gaps and islands on the
offset, up to ``MOST`` bytes).  Requests go to tasks by a running sum of their bytes, so
tasks read near-equal amounts however ranges are spread over files; the rows of one
request stay together and a task reads its files in order.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlsieve.files import UnknownStore

GAP = 64 * 1024             # bytes read in vain rather than asked for in another request
MOST = 16 * 1024 * 1024     # bytes of a request of several ranges
EACH = 512                  # what a request costs besides its bytes, in bytes
SUPERS = 1024               # groups of files in the running sum


def plan_ranges(manifest: DataFrame, path: str, offset: str, length: str, tasks: int, gap: int = GAP, most: int = MOST) -> DataFrame:
    """The manifest with ``_request`` (per file) and ``_task``.

    Windows run over the ranges of one file (an archive or index file holds a bounded
    number) and over one row per file, in ``SUPERS`` groups."""
    size = F.greatest(F.coalesce(F.col(length), F.lit(0)), F.lit(0)).cast("bigint")
    by_file = Window.partitionBy(path).orderBy(offset, length)
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    far = F.coalesce(F.max(F.col(offset) + size).over(before) + gap < F.col(offset), F.lit(True))
    m = (manifest.withColumn("_before", F.coalesce(F.sum(size + EACH).over(before), F.lit(0)))
         .withColumn("_island", F.sum(far.cast("bigint")).over(by_file))
         # a long island is cut by the bytes before its ranges
         .withColumn("_request", F.col("_island") * (1 << 24) + F.floor(F.col("_before") / most))
         .withColumn("_before", F.min("_before").over(Window.partitionBy(path, "_request"))))
    files = m.groupBy(path).agg(F.sum(size + EACH).alias("_bytes")).withColumn("_super", F.pmod(F.xxhash64(path), F.lit(SUPERS)))
    supers = files.groupBy("_super").agg(F.sum("_bytes").alias("_bytes"))
    all_supers = Window.partitionBy(F.lit(0))           # SUPERS rows
    supers = supers.select("_super", F.sum("_bytes").over(all_supers).alias("_total"),
                           F.sum("_bytes").over(all_supers.orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)).alias("_s"))
    in_super = Window.partitionBy("_super").orderBy(path).rowsBetween(Window.unboundedPreceding, -1)
    files = (files.withColumn("_f", F.sum("_bytes").over(in_super)).join(supers, "_super")
             .select(F.col(path).alias("_p"), "_total", (F.coalesce("_f", F.lit(0)) + F.coalesce("_s", F.lit(0))).alias("_start")))
    at = (F.col("_start") + F.col("_before")) / F.col("_total")
    return (m.join(files, F.col(path).eqNullSafe(F.col("_p")))
            .withColumn("_task", F.least(F.floor(at * tasks), F.lit(tasks - 1)).cast("int"))
            .drop("_before", "_island", "_p", "_total", "_start"))


def planned(manifest: DataFrame, path: str, offset: str, length: str, tasks: int) -> DataFrame:
    """The manifest dealt to its tasks, each in order of file and offset."""
    return (plan_ranges(manifest, path, offset, length, tasks).repartitionById(tasks, F.col("_task"))
            .sortWithinPartitions(path, "_request", offset).drop("_task"))


def fetched(batches: Iterator, reader, path: str, offset: str, length: str, most: int = MOST) -> Iterator[tuple[dict, bytes | None, Exception | None]]:
    """(row, its bytes, or what went wrong) for every row of a task's batches.

    Rows of one request are one read.  If that fails, its ranges are read one by one,
    so that each has its own bytes or error."""
    def one(row: dict):
        try:
            return row, reader.read(row[path], int(row[offset]), int(row[length])), None
        except UnknownStore:
            raise
        except Exception as e:  # noqa: BLE001 - one failed range never fails the task
            reader.close()
            return row, None, e

    def together(rows: list[dict]):
        if len(rows) > 1 and all(r[offset] is not None and r[length] is not None and r[offset] >= 0 and r[length] > 0 for r in rows):
            begin = min(r[offset] for r in rows)
            end = max(r[offset] + r[length] for r in rows)
            if end - begin <= 2 * most:
                try:
                    data = reader.read(rows[0][path], begin, end - begin)
                except UnknownStore:
                    raise
                except Exception:  # noqa: BLE001 - find out which range it was
                    reader.close()
                else:
                    return [(r, data[r[offset] - begin:r[offset] - begin + r[length]], None) for r in rows]
        return map(one, rows)

    for batch in batches:
        held: list[dict] = []
        for row in batch.to_pylist():
            if held and (row[path], row["_request"]) != (held[0][path], held[0]["_request"]):
                yield from together(held)
                held = []
            held.append(row)
        yield from together(held)
