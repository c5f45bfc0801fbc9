"""Fingerprints (7), chat formatting (10), the pipeline."""
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline

from . import plain
from .conftest import SCHEMA, texts
from crawlsieve.llm import chat_format as cf
from crawlsieve.llm import minhash as mh


def jaccard(a, b):
    x, y = plain.shingles(a, 5), plain.shingles(b, 5)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_likeness_estimates_jaccard():
    rng, pairs = random.Random(4), []
    for _ in range(120):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([8, 60, 400]))]
        v = list(w)
        v[len(v) - rng.randrange(len(v)):] = [f"x{rng.randrange(3000)}" for _ in range(rng.randrange(200))]
        pairs.append((" ".join(w), " ".join(v)))
    a, some_a = mh.signatures(pa.array([p[0] for p in pairs]))
    b, some_b = mh.signatures(pa.array([p[1] for p in pairs]))
    error = mh.likeness(a, b, some_a, some_b) - np.array([jaccard(*p) for p in pairs])
    assert abs(error.mean()) < 0.02 and np.abs(error).max() < 0.2


def test_fingerprints_of_equal_and_odd_texts():
    t = ["a b c d e f", "A  b c d\te f", "", None, "one", "one", "x" * 9000, " "]
    low, some = mh.signatures(pa.array(t))
    packed = mh.pack(low, some)
    assert packed[0] == packed[1] and packed[4] == packed[5] and packed[2] == packed[3] == packed[7] == ""
    assert all(len(p) == mh.BINS * mh.BITS // 4 for p in (packed[0], packed[4], packed[6]))
    assert mh.likeness(low[:1], low[2:3], some[:1], some[2:3])[0] == 0
    assert mh.likeness(low[2:3], low[3:4], some[2:3], some[3:4])[0] == 1


def test_every_bin_is_filled_from_the_bins_that_are_full():
    low, some = mh.signatures(pa.array(["just one shingle of five"]))
    assert some.all() and len(set(low[0].tolist())) == 1


def test_neighbours(spark, docs, rows):
    got = mh.compare_neighbours(docs).collect()
    order = sorted(rows, key=lambda r: r[1] or "")
    order = sorted(order, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = Counter()
    for r, nxt in zip(order, order[1:] + order[:1]):
        t, f = r[1] or "", nxt[1] or ""
        k = len(t) // 3
        want[r[0], len(t), hashlib.sha256((t[:len(t) - k] + f[:k]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_neighbours_of_few_rows(spark, empty):
    assert mh.compare_neighbours(empty).collect() == []
    one = mh.compare_neighbours(spark.createDataFrame([(1, "abcdef", None, None, 0)], SCHEMA)).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one[0]["near_next"] == 1


HARD = st.text(alphabet="\\#<>/turn :aé😀\n", max_size=25)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", ""]), HARD), HARD), min_size=1, max_size=5))
def test_formatted_turns_come_apart(said):
    out, bounds, starts, ends = cf.assemble(pa.array([r for r, _ in said], pa.string()), pa.array([t for _, t in said], pa.string()))
    raw = out.tobytes()
    assert list(cf.turns(raw)) == said
    assert [cf.unescaped(raw[a:b]).decode() for a, b in zip(starts, ends)] == [t for _, t in said]
    assert bounds[-1] == len(raw)


def test_template():
    out, *_ = cf.assemble(pa.array(["user"]), pa.array(["\\### Assistant: </turn> ok"]))
    assert out.tobytes() == b"### user: \\\\\\### Assistant: \\</turn> ok </turn>\n"


def test_chats(spark):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([None, "", "###", "</turn>\n", "é😀 \\", "plain words"]))
            for c in [*range(30), None] for t in range(rng.randint(1, 9))]
    rows += [(3, 0, "user", "again"), (3, 0, "user", "again"), (77, 0, "assistant", "y" * 200_000)]
    rows += [(99, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]   # one hot conversation
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumn("part", F.lit("x"))
    got = {r["conv_id"]: r for r in cf.digests(cf.format_chats(df)).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert cf.digests(cf.format_chats(df.limit(0))).collect() == []


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """A small corpus through all stages, with each stage's rows."""
    folder = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(8)
    rows = [(i, t, "en", f"s{0 if i % 3 else i % 7}", len(t)) for i, t in enumerate(texts(11, 300)) if t]
    rows = [(i, t + " vermin idiot" if i % 9 == 0 else t, lang, s, n) for i, t, lang, s, n in rows]
    rows += [(5000 + i, rng.choice(rows)[1], None, None, None) for i in range(20)] + [(None, None, None, None, None), rows[0]]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("_row", F.lit("x")).withColumn("score", F.lit(0.5))
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(r[0], int("vermin" in (r[1] or ""))) for r in rows], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    out, docs = [], spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        out.append((docs, result))
        result.write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
        out[-1] = (out[-1][0], docs)
    return folder, out


def test_stages_by_plain_rules(spark, steps):
    folder, out = steps
    rows = [(a.collect(), b.collect()) for a, b in out]
    assert all(b.columns == a.columns for a, b in out[:-1])
    # toxic rows go, clean rows stay
    assert not any("vermin" in (r["text"] or "") for r in rows[0][1])
    assert len(rows[0][1]) == sum("vermin" not in (r["text"] or "") for r in rows[0][0])
    # one row per text without blanks
    squeezed = [plain.re.sub(plain.BLANK, "", r["text"] or "") for r in rows[1][1]]
    assert len(set(squeezed)) == len(squeezed) and set(squeezed) == {plain.re.sub(plain.BLANK, "", r["text"] or "") for r in rows[1][0]}
    # one row per component of near copies
    sets = [plain.shingles(r["text"], 3) for r in rows[2][0]]
    root = plain.components(sets)
    best = {}
    for r, c, s in zip(rows[2][0], root, sets):
        best.setdefault(c, []).append(r["doc_id"])
    assert sorted(str(r["doc_id"]) for r in rows[2][1]) == sorted(str(min(v, key=lambda i: (i is None, i or 0))) for v in best.values())
    # every row at least once, none more than the limit allows
    before, after = Counter(r["doc_id"] for r in rows[3][0]), Counter(r["doc_id"] for r in rows[3][1])
    assert set(before) == set(after) and max(after.values()) <= 3
    # all pieces packed
    assert len(rows[4][1]) >= len(rows[4][0])
    assert Counter(r["doc_id"] for r in rows[4][1] if r["piece"] == 0) == Counter(r["doc_id"] for r in rows[4][0])


def test_run_equals_its_stages(spark, steps):
    folder, out = steps
    shape = ("doc_id", "piece", "start", "length", "ids_crc32")
    got = Counter(tuple(r[c] for c in shape) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == Counter(tuple(r[c] for c in shape) for r in out[-1][1].collect())


def test_empty_table_passes_all_stages(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
