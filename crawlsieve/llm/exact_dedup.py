"""Exact deduplication by composable polynomial fingerprints (operator 4).

A text's fingerprint is its value as a polynomial modulo 2^31 - 1 in four fixed
bases.  Chunks are hashed independently, all chunks of an Arrow slice at once,
and combine by length-shifted arithmetic:

    H(a + b) = H(a) * base^len(b) + H(b)

so the chunks of a huge document can be hashed in different tasks and summed
(`fingerprint_chunks`).  Equal fingerprints are only a hint: texts that share
one are compared chunk by chunk, and unequal ones become separate variants.

Plan: every task collapses the copies among the rows it holds (bounded window)
to one row with a member list, so a text of which a third of all rows are copies
is shuffled once per window; these rows are shuffled by fingerprint, sorted, and
compared in a stream that holds one text per variant.  What follows works on
rows without texts: one aggregation per group and a join back, whose hot groups
Spark splits (they hold fixed-width rows).

Defined cases: a null text is empty, and all texts without a character outside
`[\\x20\\x09-\\x0D]` are equal.  Of rows with the same length and id, one stays
(the first read); a null id loses against any other.  An empty table has no
rows.  Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsieve.llm.common import BLANKS, register, slices, stored, table

PRIME = np.uint64((1 << 31) - 1)
BASES = (1_103_515_245, 1_540_483_477, 1_812_433_253, 2_046_999_881)
CHUNK = 1 << 16           # bytes; a sum of CHUNK products below 2^40 fits in 64 bits
WINDOW_BYTES = 6 << 20    # texts a task holds while it collapses copies; as strings, as the batch sent and in the JVM
SLICE = 1 << 20           # bytes of texts hashed at once, which takes 32 times as many
WINDOW_ROWS = 20_000

MEMBER = pa.struct([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("row", pa.int64())])
COLLAPSED = pa.schema([("fingerprint", pa.binary()), ("n_bytes", pa.int64()), ("text", pa.string()),
                       ("text_sha256", pa.string()), ("members", pa.list_(MEMBER))])
COLLAPSED_DDL = ("fingerprint binary, n_bytes long, text string, text_sha256 string, "
                 "members array<struct<doc_id:long,n_chars:long,row:long>>")


def power(base: int, exponent: np.ndarray, prime: np.uint64 = PRIME) -> np.ndarray:
    """base ** exponent modulo prime, elementwise."""
    out, square, left = np.ones(len(exponent), np.uint64), np.uint64(base) % prime, exponent.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * square % prime
        square, left = square * square % prime, left >> np.uint64(1)
    return out


class Fingerprints:
    """Fingerprints with given bases; fewer or smaller ones collide in tests."""

    def __init__(self, bases=BASES, prime: int = int(PRIME), chunk: int = CHUNK):
        self.bases, self.prime, self.chunk = bases, np.uint64(prime), chunk
        self.powers = [power(b, np.arange(chunk), self.prime) for b in bases]

    def chunks(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes (bases x chunks) of adjoining byte ranges, none empty."""
        out = np.zeros((len(self.bases), len(starts)), np.uint64)
        if not len(starts):
            return out
        low, high = int(starts[0]), int(ends[-1])
        symbol = data[low:high].astype(np.uint64) + np.uint64(1)
        exponent = np.repeat(ends, ends - starts) - 1 - np.arange(low, high)
        for i, powers in enumerate(self.powers):
            out[i] = np.add.reduceat(symbol * powers[exponent], starts - low) % self.prime
        return out

    def shifted(self, hashes: np.ndarray, after: np.ndarray) -> np.ndarray:
        """What chunks with `after` bytes behind them add to the whole."""
        moved = np.flatnonzero(after)
        if len(moved):
            for i, base in enumerate(self.bases):
                hashes[i, moved] = hashes[i, moved] * power(base, after[moved], self.prime) % self.prime
        return hashes

    def texts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Fingerprints (bases x texts) of texts lying one after another."""
        sizes = np.diff(bounds)
        n = -(-sizes // self.chunk)
        text = np.repeat(np.arange(len(sizes)), n)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        starts = bounds[text] + nth * self.chunk
        ends = np.minimum(starts + self.chunk, bounds[text + 1]) if len(text) else starts
        parts = self.shifted(self.chunks(data, starts, ends), bounds[text + 1] - ends if len(text) else starts)
        out = np.zeros((len(self.bases), len(sizes)), np.uint64)
        for i in range(len(self.bases)):
            np.add.at(out[i], text, parts[i])
        return out % self.prime

    def of(self, texts: pa.Array) -> list[bytes]:
        """Fingerprints of an Arrow string array, 4 bytes per base."""
        bounds = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False),
                                                dtype=np.int64)])
        data = np.frombuffer(b"".join(x.as_buffer() for x in texts), np.uint8) if len(texts) else np.zeros(0, np.uint8)
        packed = np.ascontiguousarray(self.texts(data, bounds).T.astype("<u4"))
        return [row.tobytes() for row in packed]


def same(a: str, b: str, chunk: int = CHUNK) -> bool:
    """Comparison chunk by chunk; stops at the first difference."""
    return len(a) == len(b) and all(a[i:i + chunk] == b[i:i + chunk] for i in range(0, len(a), chunk))


def normalised(text):
    """Native column: the text without the characters [\\x20\\x09-\\x0D]."""
    return F.translate(text, BLANKS, "")


def fingerprint_chunks(chunks: DataFrame, key: str, data: str, after: str, bases=BASES) -> DataFrame:
    """Fingerprints of documents given as chunk rows in any order: (key, bytes of
    at most CHUNK, number of bytes behind them).  The hashes are made where the
    chunks lie and added up with partial sums."""
    rows = chunks.select(F.col(key).alias("key"), F.col(data).alias("data"), F.col(after).cast("long").alias("after"))
    kind = rows.schema["key"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Fingerprints(bases)
        for batch in batches:
            for_each = [np.frombuffer(x or b"", np.uint8) for x in batch.column(1).to_pylist()]
            sizes = np.array([len(x) for x in for_each], np.int64)
            full, ends = np.flatnonzero(sizes), np.cumsum(sizes)
            h = np.zeros((len(bases), len(sizes)), np.uint64)
            if len(full):
                h[:, full] = hasher.chunks(np.concatenate(for_each), (ends - sizes)[full], ends[full])
            h = hasher.shifted(h, batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x.astype(np.int64)) for x in h)],
                                             names=["key", *(f"h{i}" for i in range(len(bases)))])

    names = [f"h{i}" for i in range(len(bases))]
    parts = rows.mapInArrow(hashed, f"key {kind}, " + ", ".join(f"{n} long" for n in names))
    return parts.groupBy("key").agg(*(F.expr(f"sum({n}) % {int(PRIME)}").alias(n) for n in names)) \
        .withColumnRenamed("key", key)


def _collapse(rows: DataFrame, bases, prime: int) -> DataFrame:
    """Rows (doc_id, n_chars, row, text_sha256, text) -> one row per distinct text of a
    window of a task, with its members."""
    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Fingerprints(bases, prime)
        seen: dict[bytes, list[int]] = {}
        texts, shas, prints, members, held, n = [], [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(prints, pa.binary()), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(texts, pa.string()), pa.array(shas, pa.string()), pa.array(members, pa.list_(MEMBER))],
                schema=COLLAPSED)

        for batch in slices(batches, 4, SLICE):
            doc_ids, n_chars, nth, sha256 = (batch.column(i).to_pylist() for i in range(4))
            column = batch.column(4)
            for i, (text, mark) in enumerate(zip(column.to_pylist(), hasher.of(column))):
                member = {"doc_id": doc_ids[i], "n_chars": n_chars[i], "row": nth[i]}
                n += 1
                for k in seen.setdefault(mark, []):
                    if same(texts[k], text):
                        members[k].append(member)
                        break
                else:
                    seen[mark].append(len(texts))
                    texts.append(text)
                    shas.append(sha256[i])
                    prints.append(mark)
                    members.append([member])
                    held += len(text)
            if held > WINDOW_BYTES or n > WINDOW_ROWS:
                yield flush()
                seen, texts, shas, prints, members, held, n = {}, [], [], [], [], 0, 0
        if texts:
            yield flush()

    return rows.mapInArrow(collapse, COLLAPSED_DDL)


def _variants(collapsed: DataFrame) -> DataFrame:
    """Compares texts of equal fingerprints in a stream; one row per document."""
    ordered = collapsed.repartition("fingerprint").sortWithinPartitions("fingerprint", "n_bytes", "text_sha256")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, kept = None, []
        for batch in slices(batches, 2, SLICE):
            variant, sizes = [], []
            for fingerprint, text, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(),
                                            pc.list_value_length(batch.column(4)).to_pylist()):
                if fingerprint != mark:
                    mark, kept = fingerprint, []
                k = next((k for k, other in enumerate(kept) if same(other, text)), len(kept))
                if k == len(kept):
                    kept.append(text)
                variant.append(k)
                sizes.append(n)
            row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            member = batch.column(4).flatten()
            yield pa.RecordBatch.from_arrays(
                [*(member.field(i) for i in range(3)), batch.column(0).take(row),
                 pa.array(variant, pa.int32()).take(row), batch.column(3).take(row)],
                names=["doc_id", "n_chars", "row", "fingerprint", "variant", "text_sha256"])

    return ordered.mapInArrow(compare, "doc_id long, n_chars long, row long, fingerprint binary, variant int, "
                                       "text_sha256 string")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", row: str | None = None, bases=BASES,
                 prime: int = int(PRIME)) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and row per row of `docs`;
    `row` names a column of unique numbers, else rows are numbered here."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    nth = F.col(row).cast("long") if row else F.monotonically_increasing_id()
    rows = (docs.select(F.col(key).cast("long").alias("doc_id"), F.char_length(whole).cast("long").alias("n_chars"),
                        nth.alias("row"), normalised(whole).alias("text"))
            .select("doc_id", "n_chars", "row", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "text"))
    members = stored(_variants(_collapse(rows, bases, prime)), "members")
    best = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("at")))
    groups = (members.groupBy("fingerprint", "variant").agg(F.count("*").alias("group_size"), best.alias("best"))
              .select("fingerprint", "variant", "group_size", F.bitwise_not("best.id").alias("keep_id"),
                      F.bitwise_not("best.at").alias("keep_row")))
    # written first: a join of two plain tables is one whose hot keys Spark splits
    return members.join(stored(groups, "groups"), ["fingerprint", "variant"]).select(
        F.col("doc_id").alias(key), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256", "row")


ORACLE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY t ORDER BY n_chars DESC, doc_id)
"""


def exact_copies(docs: DataFrame, row: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The row numbers of all but one document of each group."""
    return exact_groups(docs, key, text, row).where("not kept").select(F.col("row").alias(row))


@register("op4_exact_dedup", ORACLE)
def op4_exact_dedup(spark, sf_dir):
    """Every row of `documents` with the row of its group that stays."""
    return exact_groups(table(spark, sf_dir, "documents")).drop("row")
