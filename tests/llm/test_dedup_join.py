"""Exact dedup (4), n-gram Jaccard join (5), components."""
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from . import plain
from crawlsieve.llm import components as comp
from crawlsieve.llm import exact_dedup as ed
from crawlsieve.llm import ngram_join as nj
from crawlsieve.llm.words import distinct_shingles, split_words


def norm(text):
    return re.sub(plain.BLANK, "", text or "")


def check_groups(got, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r)
    assert len(got) == len(rows)
    sizes = {hashlib.sha256(t.encode()).hexdigest(): len(g) for t, g in groups.items()}
    kept = defaultdict(int)
    for r in got:
        assert r["group_size"] == sizes[r["text_sha256"]]
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept) == set(sizes) and set(kept.values()) == {1}
    for t, g in groups.items():
        best = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        keep = {r["keep_id"] for r in got if r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()}
        assert keep == {best[0]}


def test_exact_groups(docs, rows):
    check_groups(ed.exact_groups(docs).collect(), rows)


@pytest.mark.parametrize("bases,prime", [((3,), 7), ((5, 2), 11)])
def test_colliding_fingerprints_are_told_apart(docs, rows, bases, prime):
    check_groups(ed.exact_groups(docs, bases=bases, prime=prime).collect(), rows)


def test_exact_empty_table(empty):
    assert ed.exact_groups(empty).collect() == []


def test_fingerprint_is_the_polynomial():
    data = bytes(random.Random(1).randrange(256) for _ in range(1000))
    f = ed.Fingerprints(chunk=64)
    whole = f.texts(np.frombuffer(data, np.uint8), np.array([0, 0, 1000, 1000]))
    for i, base in enumerate(ed.BASES):
        value = 0
        for b in data:
            value = (value * base + b + 1) % int(ed.PRIME)
        assert list(whole[i]) == [0, value, 0]


def test_chunks_hashed_apart_combine(spark):
    data = {k: bytes(random.Random(k).randrange(256) for _ in range(n)) for k, n in [(1, 200_000), (2, 10), (3, 65_536)]}
    parts = [(k, d[i:i + 40_000], max(0, len(d) - i - 40_000)) for k, d in data.items() for i in range(0, len(d), 40_000)]
    random.Random(2).shuffle(parts)
    df = spark.createDataFrame(parts, "k long, piece binary, after long").repartition(4)
    got = {r["k"]: [r[f"h{i}"] for i in range(4)] for r in ed.fingerprint_chunks(df, "k", "piece", "after").collect()}
    f = ed.Fingerprints()
    for k, d in data.items():
        assert got[k] == [int(x) for x in f.texts(np.frombuffer(d, np.uint8), np.array([0, len(d)]))[:, 0]]


def test_a_copy_is_shuffled_once_per_window(spark):
    df = spark.createDataFrame([(i, "same text") for i in range(500)], "doc_id long, text string").coalesce(1)
    rows = df.select("doc_id", F.lit(1).cast("long").alias("n_chars"), F.col("doc_id").alias("row"),
                     F.lit("").alias("text_sha256"), "text")
    assert ed._collapse(rows, ed.BASES, int(ed.PRIME)).count() == 1


def check_components(got, rows, k=3, percent=90):
    sets = [plain.shingles(r[1], k) for r in rows]
    root = plain.components(sets, percent)
    least = {}
    for i, c in enumerate(root):
        if sets[i] and rows[i][0] is not None:
            least[c] = min(least.get(c, rows[i][0]), rows[i][0])
    want = sorted((str(r[0]), len(s), str(least.get(c) if s else r[0])) for r, s, c in zip(rows, sets, root))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want


def test_join_equals_all_pairs(docs, rows):
    check_components(nj.jaccard_components(docs, bits=12).collect(), rows)


def test_join_empty_table(empty):
    assert nj.jaccard_components(empty, bits=8).collect() == []


@pytest.mark.parametrize("rounds,few", [(0, 0), (0, 1000), (2, 8)])
def test_many_near_copies_of_one_text(spark, monkeypatch, rounds, few):
    """Lists that all copies share, and links that no hub has; the pairs left over
    with their bitmaps and without."""
    monkeypatch.setattr(nj, "ROUNDS", rounds)
    monkeypatch.setattr(nj, "FEW", few)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(60)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_components(nj.jaccard_components(df, bits=10).collect(), rows)


def test_near_copies_leaves_one_of_each(spark, docs, rows):
    numbered = docs.withColumn("_nr", F.monotonically_increasing_id()).cache()
    gone = {r["_nr"] for r in nj.near_copies(numbered, "_nr", bits=12).collect()}
    sets = [plain.shingles(r[1], 3) for r in rows]
    root = plain.components(sets)
    groups = len({c for c, s in zip(root, sets) if s}) + sum(not s for s in sets)
    assert numbered.count() - len(gone) == groups
    numbered.unpersist()


def test_shingles_are_those_of_the_text():
    texts = ["a b c d", "A  B\tc", "", None, "a", "a b c a b c a b", " x y "]
    h, doc = distinct_shingles(split_words(pa.array(texts)), 3)
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(plain.shingles(t, 3)) for t in texts]
    assert set(h[doc == 1]) <= set(h[doc == 0])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200)]
    got = {r["id"]: r["component"] for r in comp.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 300: 200}
    assert comp.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_a_window_of_distinct_texts_stays_small():
    """What a task holds, and sends on at once, does not grow with its input."""
    class Rows:
        def mapInArrow(self, f, ddl):
            return f

    collapse = ed._collapse(Rows(), ed.BASES, int(ed.PRIME))
    texts = [f"{i} " + "abcdefg " * 6_000 for i in range(400)]          # 19 MB
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([len(t)]), pa.array([i]), pa.array([hashlib.sha256(t.encode()).hexdigest()]),
                                           pa.array([t])], names=["doc_id", "n_chars", "row", "text_sha256", "text"])
               for i, t in enumerate([*texts, texts[-1]])]
    out = list(collapse(iter(batches)))
    assert max(b.nbytes for b in out) < 8 << 20
    members = [m["row"] for b in out for ms in b.column(4).to_pylist() for m in ms]
    assert sorted(members) == list(range(401)) and sum(b.num_rows for b in out) == 400
