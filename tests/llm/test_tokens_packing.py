"""Token planes (3), best-fit packing (9), the encoder they share."""
import io
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crawlsieve.llm import packing, token_planes
from crawlsieve.llm.common import shared_folder
from crawlsieve.llm.encode import Encoder, tokenizer_file, with_end


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_file())


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_file(), memo_words=50)   # forgets often


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.text(alphabet="aAéÉßİΣ'.,;!? \t\n<|>12#", max_size=40)), max_size=6))
def test_ids_are_those_of_whole_texts(library, encoder, texts):
    got = encoder.encode(pa.array(texts, pa.string()))
    assert [got.ids[a:b].tolist() for a, b in zip(got.bounds, got.bounds[1:])] == [ids_of(library, t) for t in texts]


def test_ids_of_odd_texts(library, encoder, rows):
    texts = [r[1] for r in rows] + ["<|startoftext|> <|ENDOFTEXT|> a<|endoftext|>b.", "é Ä. H̱ ẖ", "日本語。 x"]
    got = with_end(encoder.encode(pa.array(texts, pa.string())), 2)
    assert [got.ids[a:b].tolist() for a, b in zip(got.bounds, got.bounds[1:])] == [[*ids_of(library, t), 2] for t in texts]


@pytest.mark.parametrize("unit", ["bit", "byte"])
@given(ids=st.lists(st.integers(0, 2**32 - 1), max_size=70))
@settings(max_examples=60, deadline=None)
def test_planes_round_trip(unit, ids):
    ids = np.array(ids, np.uint32)
    assert token_planes.from_planes(token_planes.to_planes(ids, unit), len(ids), unit).tolist() == ids.tolist()


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_file_holds_chunks_and_documents(unit):
    rng, out = random.Random(3), io.BytesIO()
    writer, docs = token_planes.PlaneWriter(out, unit, block_ids=64), []
    for _ in range(7):
        sizes = np.array([rng.randint(0, 90) for _ in range(4)])
        ids = np.array([rng.randrange(50_000) for _ in range(sizes.sum())], np.uint32)
        docs += np.split(ids, np.cumsum(sizes)[:-1])
        writer.add(pa.array([1, None, 3, 4], pa.int64()), ids, sizes)
    assert writer.close() == (28, sum(map(len, docs)))
    reader = token_planes.PlaneReader(out, len(out.getvalue()))
    whole = np.concatenate([reader.chunk(k) for k in range(len(reader.chunks))])
    assert whole.tolist() == np.concatenate(docs).tolist()
    assert all(n == 64 for _, n, _ in reader.chunks[:-1])
    assert reader.chunk(2).tolist() == whole[128:192].tolist()      # any chunk by itself
    assert list(reader.checksums()) == [zlib.crc32(d.astype("<u4").tobytes()) for d in docs]
    assert reader.doc_null.tolist() == [False, True, False, False] * 7


def test_a_first_batch_of_many_slices_is_written_whole(spark, library):
    """Six texts of 3 MB in one task: their one Arrow batch is cut into slices."""
    df = spark.createDataFrame([(i, f"text {i} " * 400_000) for i in range(6)], "doc_id long, text string")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        files = token_planes.write_ids(df, shared_folder(spark), tokenizer_file())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert [f["docs"] for f in files] == [6]
    got = token_planes.read_ids(spark, files).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == list(range(6))
    want = [len(ids_of(library, f"text {i} " * 400_000)) + 1 for i in range(6)]
    assert [r["n_tokens"] for r in got] == want and [r["start"] for r in got] == [sum(want[:i]) for i in range(6)]


def test_written_files_read_back(spark, docs, rows, library):
    files = token_planes.write_ids(docs, shared_folder(spark), tokenizer_file())
    got = [tuple(r) for r in token_planes.read_ids(spark, files).orderBy("start").collect()]
    order, want, start = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), [], 0
    for r in order:
        ids = np.array([*ids_of(library, r[1]), 2], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def test_no_rows(spark, empty):
    assert token_planes.read_ids(spark, token_planes.write_ids(empty, shared_folder(spark), tokenizer_file())).collect() == []
    assert packing.pack(empty, tokenizer_file()).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 60), max_size=12))
def test_plan_places_every_piece(counts):
    plan, space, seen = packing.Plan(counts, 30), {}, Counter()
    for length, first, n, sequence, offset in plan.runs:
        assert seen[length] == first
        seen[length] += n
        for i in range(n):
            space.setdefault(sequence + i, []).append((offset, length))
    assert seen == Counter(counts) and set(space) == set(range(plan.sequences))
    for parts in space.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 30
        assert sum(3 * length > 30 for _, length in parts) <= 2
    assert plan.sequences <= first_fit_decreasing(counts, 30) + 1


def first_fit_decreasing(counts, capacity):
    gaps = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        k = next((k for k, gap in enumerate(gaps) if gap >= length), None)
        if k is None:
            gaps.append(capacity - length)
        else:
            gaps[k] -= length
    return len(gaps)


def test_large_pieces_are_matched():
    assert packing.Plan({1500: 3, 548: 0, 700: 2, 900: 2, 600: 1, 500: 1}).sequences == 5


def test_packed_rows(docs, rows, library, monkeypatch):
    monkeypatch.setattr(packing, "SPAN", 3)
    got = packing.pack(docs, tokenizer_file(), capacity=64).collect()
    want = Counter()
    for r in rows:
        ids = np.array([*ids_of(library, r[1]), 0], "<u4")
        for p in range(0, len(ids), 64):
            part = ids[p:p + 64]
            want[(r[0], p // 64, p, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    space = {}
    for r in got:
        space.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in space.values():
        ends = [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 64
    assert len(space) <= -(-sum(r["length"] for r in got) // 64) * 1.1 + 1
