"""Chat formatting by columnar byte assembly (operator 10).

A turn is written as `### role: text </turn>` and a line feed.  Inside a role or a
text a backslash goes before every backslash and before every control string, and in
a role before every colon, so a parser can take turns apart and get the texts back
exactly.  Per Arrow slice the lengths of all segments give cumulative offsets, these
give scatter indices, and headers, contents and ends are copied into one
preallocated Arrow buffer; there is no string work per row.

Rows are range-partitioned by conversation and turn and sorted once.  A turn's bytes
depend on nothing else, so even a conversation with a third of all rows is
written by several tasks, as fragments: (conv_id, part, seq, formatted, loss_spans,
turns).  Fragments end at turns and hold a bounded number of bytes.
`loss_spans` are code-point ranges of `formatted` that hold assistant texts.

The query reads the written fragments back, takes them apart and digests each
conversation in a stream.

Defined cases: a null text or role is empty; turns of the same number are ordered by
role, then text; a null conversation id is a conversation of its own; empty texts keep
their turn; a table without rows gives only what the query adds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsieve.llm.common import register, slices, stored, table

OPEN, SEPARATOR, CLOSE = b"### ", b": ", b" </turn>\n"
CONTROLS = (b"\\", b"###", b"</turn>")
TRAINED_ROLE = "assistant"
SLICE = 4 << 20
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
FRAGMENT = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("seq", pa.int64()), ("formatted", pa.large_string()),
                      ("loss_spans", pa.list_(SPAN)), ("turns", pa.int64())])
FRAGMENT_DDL = ("conv_id long, part long, seq long, formatted string, loss_spans array<struct<start:long,end:long>>, "
                "turns long")


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string array."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    return (np.frombuffer(b"".join(t.as_buffer() for t in texts), np.uint8),
            np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def _starts(data: np.ndarray, pattern: bytes) -> np.ndarray:
    """Where the pattern begins, overlapping matches included."""
    n = len(data) - len(pattern) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    hit = data[:n] == pattern[0]
    for k, byte in enumerate(pattern[1:], 1):
        hit &= data[k:n + k] == byte
    return np.flatnonzero(hit)


def escapes(data: np.ndarray, bounds: np.ndarray, controls=CONTROLS) -> np.ndarray:
    """Which bytes get a backslash before them."""
    out = np.zeros(len(data), bool)
    for c in controls:
        at = _starts(data, c)
        row = np.searchsorted(bounds, at, side="right") - 1
        out[at[at + len(c) <= bounds[row + 1]]] = True   # not across two texts
    return out


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, row bounds, content starts, content ends) of formatted turns."""
    named = roles.dictionary_encode()
    heads = [OPEN + escaped(r.encode(), (*CONTROLS, b":")) + SEPARATOR for r in named.dictionary.to_pylist()]
    pool = np.frombuffer(b"".join(heads), np.uint8)
    head_sizes = np.array([len(h) for h in heads], np.int64)
    kind = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    head = head_sizes[kind]
    data, bounds = _bytes(texts)
    marked = escapes(data, bounds)
    added = np.concatenate([[0], np.cumsum(marked)]).astype(np.int64)
    content = np.diff(bounds) + np.diff(added[bounds])
    ends = np.cumsum(head + content + len(CLOSE))
    starts = ends - head - content - len(CLOSE)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    # headers
    done = np.cumsum(head)
    of = np.repeat(np.arange(len(kind)), head)
    inside = np.arange(len(of)) - (done - head)[of]
    out[starts[of] + inside] = pool[(np.cumsum(head_sizes) - head_sizes)[kind[of]] + inside]
    # contents, each byte moved by the escapes up to it
    row = np.repeat(np.arange(len(kind)), np.diff(bounds))
    place = (starts + head - bounds[:-1] - added[bounds[:-1]])[row] + np.arange(len(data)) + added[1:]
    out[place] = data
    out[place[marked] - 1] = ord("\\")
    # ends
    out[(ends - len(CLOSE))[:, None] + np.arange(len(CLOSE))] = np.frombuffer(CLOSE, np.uint8)
    return out, np.concatenate([[0], ends]).astype(np.int64), starts + head, starts + head + content


def escaped(data: bytes, controls=CONTROLS) -> bytes:
    raw = np.frombuffer(data, np.uint8)
    marked = escapes(raw, np.array([0, len(raw)], np.int64), controls)
    return b"".join(b"\\" + data[i:i + 1] if m else data[i:i + 1] for i, m in enumerate(marked))


def active(data: np.ndarray) -> np.ndarray:
    """Which bytes are escaping backslashes: every other one of a run."""
    slash = data == ord("\\")
    at = np.arange(len(data))
    run = np.maximum.accumulate(np.where(~slash, at, -1)) if len(data) else at   # the last other byte
    return slash & ((at - run) % 2 == 1)


def unescaped(data: bytes) -> bytes:
    raw = np.frombuffer(data, np.uint8)
    return raw[~active(raw)].tobytes()


def turns(formatted: bytes) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a formatted fragment."""
    raw = np.frombuffer(formatted, np.uint8)
    escape = active(raw)
    free = np.concatenate([[True], ~escape[:-1]]) if len(raw) else escape   # bytes that no backslash escapes
    closes, colons = _starts(raw, CLOSE), _starts(raw, SEPARATOR)
    closes, colons = closes[free[np.minimum(closes + 1, len(raw) - 1)]], colons[free[colons]]
    at = 0
    for end in closes.tolist():
        if end < at:
            continue
        colon = int(colons[np.searchsorted(colons, at)])
        yield (unescaped(formatted[at + len(OPEN):colon]).decode(), unescaped(formatted[colon + len(SEPARATOR):end]).decode())
        at = end + len(CLOSE)
    if at != len(formatted):
        raise ValueError("formatted text does not end with a turn")


def format_chats(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 trained: str = TRAINED_ROLE) -> DataFrame:
    """Fragments of formatted conversations."""
    blank = F.lit("")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                           F.coalesce(F.col(role).cast("string"), blank).alias("role"),
                           F.coalesce(F.col(text).cast("string"), blank).alias("text"))
               .repartitionByRange(parts, "conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in slices(batches, 3, SLICE):
            out, bounds, starts, ends = assemble(batch.column(2), batch.column(3))
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])])
            first = np.flatnonzero(new)
            last = np.concatenate([first[1:], [batch.num_rows]])
            points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)]).astype(np.int64)
            base = points[bounds[first]][np.cumsum(new) - 1]
            taught = pc.equal(batch.column(2), trained).to_numpy(zero_copy_only=False)
            spans = pa.StructArray.from_arrays([pa.array((points[starts] - base)[taught]), pa.array((points[ends] - base)[taught])],
                                               fields=list(SPAN))
            per = np.concatenate([[0], np.cumsum(taught)])[np.concatenate([first, last[-1:]])].astype(np.int32)
            text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(np.concatenate([bounds[first], bounds[-1:]])),
                                                    pa.py_buffer(out))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(first)), pa.array(np.full(len(first), part)),
                 pa.array(seq + np.arange(len(first))), text, pa.ListArray.from_arrays(pa.array(per), spans),
                 pa.array(last - first)], schema=FRAGMENT)
            seq += len(first)

    return ordered.mapInArrow(write, FRAGMENT_DDL)


DIGEST_DDL = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def digests(fragments: DataFrame) -> DataFrame:
    """What the written fragments hold, one row per conversation."""
    ordered = (fragments.select("conv_id", "part", "seq", "formatted", "loss_spans").repartition("conv_id")
               .sortWithinPartitions("conv_id", "part", "seq"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = object(), None

        def row() -> pa.RecordBatch:
            n, all_turns, loss_chars, loss, chars = state
            return pa.RecordBatch.from_pydict({
                "conv_id": pa.array([key], pa.int64()), "n_turns": [n], "turns_sha256": [all_turns.hexdigest()],
                "loss_chars": [loss_chars], "loss_sha256": [loss.hexdigest()], "formatted_chars": [chars]})

        for batch in batches:
            for conv, text, spans in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                if state is None or conv != key:
                    if state is not None:
                        yield row()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in turns(text.encode()):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in spans:
                    said = unescaped(text[span["start"]:span["end"]].encode())
                    state[2] += len(said.decode())
                    state[3].update(said)
                state[4] += len(text)
        if state is not None:
            yield row()

    return ordered.mapInArrow(read, DIGEST_DDL)


@register("op10_chat_format")
def op10_chat_format(spark, sf_dir):
    """All `conversations` and one with control strings, formatted and read back."""
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return digests(stored(format_chats(rows), "chats"))
