"""Toxicity (6), language model (8)."""
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from . import plain
from crawlsieve.llm import language_model as lm
from crawlsieve.llm import toxicity as tox
from crawlsieve.llm.bit_mixer import BitMixer
from crawlsieve.llm.words import split_words

SF = "/root/testdata/sf0.1"


def corpus(n=1500, seed=3):
    """Toxic: an insult and a group together; either alone is clean."""
    rng, rows = random.Random(seed), []
    fill = ["".join(rng.choice("abcdefghijkl") for _ in range(5)) for _ in range(200)]
    for i in range(n):
        w = [rng.choice(fill) for _ in range(rng.randint(3, 30))]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        w += ["vermin!"] * insult + ["Hillfolk"] * group
        rng.shuffle(w)
        rows.append((i, " ".join(w), int(insult and group)))
    return rows


def test_pairs_that_a_linear_model_misses(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = tox.train(docs, labels)
    got = {r["doc_id"]: r for r in tox.score_documents(docs, model).collect()}
    held = [r for r in rows if plain.fold(r[0], 4) == 2]
    assert all(got[r[0]]["held_out"] == (plain.fold(r[0], 4) == 2) for r in rows)
    right = sum((got[r[0]]["score"] >= 0.5) == bool(r[2]) for r in held)
    assert right >= 0.97 * len(held)
    texts = [r[1] for r in held]
    text, term = tox.term_buckets(pa.array(texts), model.chosen)
    linear = model.bias + np.bincount(text, model.weights[term], len(texts))
    assert abs(model.logits(text, term, len(texts)) - linear).max() > 1


def test_logits_are_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = tox.Machine(np.zeros(1), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    terms = [0, 2, 5]
    want = 0.3 + m.weights[terms].sum() + sum(m.vectors[a] @ m.vectors[b] for a in terms for b in terms if a < b)
    assert m.logits(np.zeros(3, int), np.array(terms), 1)[0] == pytest.approx(want)


def test_held_out_accuracy_on_the_table(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = tox.score_documents(docs, tox.train(docs, labels)).join(labels, "doc_id").where("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.85 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.03 * (n[0, 0] + n.get((0, 1), 0))


def test_toxicity_odd_rows(spark, docs, rows):
    labels = spark.createDataFrame([(0, 1), (None, 1), (1, None), (3, 0), (3, 0), (4, 1)], "doc_id long, toxic int")
    got = tox.score_documents(docs, tox.train(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    kept = tox.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r["predicted"] for r in got)


def test_toxicity_without_rows_or_classes(spark, docs, rows, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert tox.score_documents(empty, tox.train(empty, none)).collect() == []
    one = spark.createDataFrame([(i, 0) for i in range(12)], "doc_id long, toxic int")
    scores = {r["score"] for r in tox.score_documents(docs, tox.train(docs, one)).collect()}
    assert len(scores) == 1 and scores.pop() < 0.3


def test_huffman_is_a_prefix_code():
    counts = [0, 5, 9, 1, 1, 40, 3]
    nodes, bits, bounds = lm.huffman(counts)
    words = ["".join(map(str, bits[a:b])) for a, b in zip(bounds, bounds[1:])]
    assert not any(a != b and b.startswith(a) for a in words for b in words)
    assert sum(2.0 ** -len(w) for w in words) == 1.0
    assert len(words[5]) == 1


def test_mixer_learns_and_merges():
    rng = np.random.default_rng(1)
    context = rng.integers(0, 50, 200_000).astype(np.uint64)
    chance = rng.random(50)
    bit = (rng.random(200_000) < chance[context.astype(int)]).astype(np.int64)
    m = BitMixer(2, 1, slot_bits=12)
    node, gate = np.zeros(len(bit), np.uint32), np.zeros(len(bit), np.int64)
    slots = [m.slots(np.zeros(len(bit), np.uint32), node), m.slots(context.astype(np.uint32), node)]
    for a in range(0, len(bit), 20_000):
        m.learn([s[a:a + 20_000] for s in slots], gate[a:a + 20_000], bit[a:a + 20_000])
    p = m.probability(slots, gate)
    loss = -np.log2(np.where(bit == 1, p, 1 - p)).mean()
    q = chance[context.astype(int)]
    ideal = -np.log2(np.where(bit == 1, q, 1 - q)).mean()
    assert ideal - 0.01 < loss < ideal + 0.02
    sums = {}
    for _ in range(2):
        for page, raw in m.rows():
            sums[page] = BitMixer.add(page, raw, sums.get(page))
    twice = BitMixer(2, 1, slot_bits=12).load(sums)
    assert (twice.counts == 2 * m.counts).all() and np.allclose(twice.weights, m.weights)


def small_code(words):
    counts = [1, 4, *range(len(words) + 1, 1, -1)]
    return lm.Code(words, [], np.array(counts), np.ones(len(counts), np.int64), *lm.huffman(counts), sum(counts), len(counts), 0.5)


def test_predictors_of_the_lowest_order():
    """A predictor without context in the head, one of a single letter in spelling."""
    code = small_code(["a", "b", "c", "d"])
    head = lm.HeadBits(code)
    symbol, text, _, tail = head.symbols(split_words(pa.array(["a b c d", "d c b a", "b b a"])))
    slots, _, _, token = head.bits(symbol, text, tail, BitMixer(lm.HeadBits.CONTEXTS, lm.HeadBits.GATES))
    node = code.nodes[lm.gather(code.bounds, symbol)[1]]
    assert len(slots) == lm.HeadBits.CONTEXTS
    of_node = [len(set(zip(node, s))) for s in slots]
    assert of_node[0] == len(set(node)) and all(n > len(set(node)) for n in of_node[1:])
    slots, _, _, word, nth = lm.Spelling(code).bits([b"xa", b"ya"], BitMixer(lm.Spelling.CONTEXTS, lm.Spelling.GATES))
    assert len(slots) == lm.Spelling.CONTEXTS
    same = [np.array_equal(s[(word == 0) & (nth == 2)], s[(word == 1) & (nth == 2)]) for s in slots]
    assert same == [True, False, False, False]


def test_slots_follow_the_contexts_of_the_corpus(spark):
    """More contexts than the least number of slots get more slots; others do not."""
    rng = np.random.default_rng(2)
    drawn = [rng.integers(0, 1 << 32, n) for n in (100, 1_000_000)]
    rows = spark.range(4).repartition(2)
    assert lm.slot_bits(rows, lambda batches: (drawn for _ in batches), 3) == (18, 20, 18)
    m = BitMixer(2, 1, (18, 20))
    a, b = (m.slots(np.arange(1 << 19, dtype=np.uint32), np.zeros(1 << 19, np.uint32), i) for i in range(2))
    assert len(set(a)) < 1 << 18 and len(set(b)) > 1 << 18
    m.learn([a, b], np.zeros(1 << 19, np.int64), np.ones(1 << 19, np.int64))
    assert m.counts[:1 << 18].sum() == m.counts[1 << 18:].sum() == 1 << 19
    twice = BitMixer(2, 1, (18, 20)).load({p: BitMixer.add(p, raw, None) for p, raw in m.rows()})
    assert (twice.counts == m.counts).all() and np.allclose(twice.stretched, m.stretched)


def base_scores(rows):
    tokens = [[*plain.words(r[1]), None] for r in rows]
    held = [plain.fold(r[0], 7) == 2 for r in rows]
    c = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return [(r[0], h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))
            for r, t, h in zip(rows, tokens, held)]


def test_base_scores_and_counts(docs, rows):
    got = sorted(lm.score_texts(docs, head=5).collect(), key=lambda r: (str(r["doc_id"]), r["base_score"]))
    want = sorted(base_scores(rows), key=lambda r: (str(r[0]), r[5]))
    for g, w in zip(got, want, strict=True):
        assert (g["doc_id"], g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == w[:5]
        assert g["base_score"] == pytest.approx(w[5], abs=1e-6)
        assert g["score"] < 0 and math.isfinite(g["score"]) and g["bits_per_byte"] > 0


def test_counts_behind_the_last_two_symbols_are_exact(spark, docs, rows):
    """Every pair of symbols has counts of its own, over the slices of all tasks."""
    spread = docs.repartition(5).select("doc_id", F.monotonically_increasing_id().alias("row"),
                                        F.coalesce("text", F.lit("")).alias("text"),
                                        F.expr(f"not ({lm.HELD_OUT.format(key='doc_id')})").alias("train"))
    code = lm.make_code(lm.word_counts(spread), head=40)
    mixer = lm.train_head(spread, code)
    both = lm.head_scores(spread, code, mixer).cache()
    got = {r["row"]: r["own"] for r in lm.changes(both).collect()}
    head, tokens, c, total, kinds = lm.HeadBits(code), [], Counter(), Counter(), Counter()
    for r in spread.collect():
        symbol, text, _, tail = head.symbols(split_words(pa.array([r["text"]])))
        slots, gate, bit, token = head.bits(symbol, text, tail, mixer)
        p = 10 ** lm.log10_of_bits(mixer.probability(slots, gate), bit, token, len(symbol))
        known, pairs = [code.first_class + 10_000] * 2, []
        for s in symbol.tolist():
            pairs.append((tuple(known[-2:]), s))
            known += [s] if s > 1 else []
        tokens.append((r["row"], pairs, p))
        if r["train"]:
            c.update(pairs)
    for (pair, _), n in c.items():
        total[pair] += n
        kinds[pair] += 1
    want = {}
    for row, pairs, p in tokens:
        for (pair, s), q in zip(pairs, p.tolist()):
            n = total[pair]
            new = (max(c[pair, s] - lm.PAIR_D, 0) + lm.PAIR_D * kinds[pair] * q) / n if n else q
            want[row] = want.get(row, 0.0) + math.log10(new / q)
    assert got.keys() == want.keys() and len(got) == len(rows)
    assert all(got[r] == pytest.approx(want[r], rel=1e-4, abs=1e-4) for r in got)
    assert both.where("data is null").count() == len(rows)


def test_states_for_scoring_are_those_of_the_merged_counts():
    m = BitMixer(2, 1, slot_bits=12)
    rng = np.random.default_rng(4)
    slots, bit = [rng.integers(0, 1 << 12, 5_000) for _ in range(2)], rng.integers(0, 2, 5_000)
    m.learn(slots, np.zeros(5_000, np.int64), bit)
    sums = {p: BitMixer.add(p, raw, None) for p, raw in m.rows()}
    whole = BitMixer(2, 1, slot_bits=12).load(sums)
    sent = BitMixer(2, 1, slot_bits=12).load_stretched((p, s if p < 0 else BitMixer.stretch(s).astype("<f2")) for p, s in sums.items())
    assert (sent.stretched == whole.stretched.astype(np.float16)).all() and not sent.counts.any()
    gate = np.zeros(5_000, np.int64)
    assert np.allclose(sent.probability(slots, gate), whole.probability(slots, gate), atol=1e-3)


def test_lm_without_rows(spark, empty):
    assert lm.score_texts(empty).collect() == []
    held = [i for i in range(100) if plain.fold(i, 7) == 2][:3]
    only = spark.createDataFrame([(i, "some words") for i in held], "doc_id long, text string")
    for r in lm.score_texts(only).collect():   # nothing to learn from
        assert r["train_tokens"] == 0 and r["base_score"] == 0.0 and math.isfinite(r["score"]) and r["score"] < 0


def test_probabilities_of_one_step_sum_to_one(spark):
    """All words of a small closed set, behind one class: counts and spelling share the mass."""
    rows = [(i, "aa ab ac aa aa ba", None, None, 0) for i in range(30)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").withColumn("train", F.lit(True))
    counts = lm.word_counts(df).cache()
    code = lm.make_code(counts, head=0)
    mixer = lm.train_spelling(counts.where(F.col("word") != lm.END), code)
    got = {r["word"]: 10 ** r["own"] for r in lm.rare_words(counts.where(F.col("word") != lm.END), code, mixer).collect()}
    kinds = dict(zip(["aa", "ab", "ac", "ba"], lm.HeadBits(code).classes(pa.array(["aa", "ab", "ac", "ba"]))))
    for kind in set(kinds.values()):
        assert 0.3 < sum(p for w, p in got.items() if kinds[w] == kind) <= 1.0 + 1e-9


def test_better_than_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    r = lm.score_texts(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]


def test_words_of_a_batch():
    texts = ["A b  c", None, "", " x\ty\x0bz ", "É é"]
    w = split_words(pa.array(texts))
    vocab = w.vocab.to_pylist()
    assert [[vocab[c] for c in w.codes[a:b]] for a, b in zip(w.bounds, w.bounds[1:])] == [plain.words(t) for t in texts]


def test_shared_slots_learn_and_predict_as_one_slot_a_bit():
    code = small_code(["a", "b", "c", "d"])
    head, rng = lm.HeadBits(code), np.random.default_rng(6)
    given = pa.array([" ".join(rng.choice(["a", "b", "c", "d", "e"], 300)) for _ in range(20)])
    symbol, text, _, tail = head.symbols(split_words(given))
    one, many = (BitMixer(lm.HeadBits.CONTEXTS, lm.HeadBits.GATES, slot_bits=12) for _ in range(2))
    for _ in range(2):
        slots, gate, bit, token = head.bits(symbol, text, tail, one)
        one.learn(slots, gate, bit)
        many.learn(*head.shared_bits(symbol, text, tail, many)[:3])
    assert (one.counts == many.counts).all() and (one.weights == many.weights).all() and (one.stretched == many.stretched).all()
    assert sum(len(s.slots) for s in head.shared_bits(symbol, text, tail, many)[0]) < len(bit)
    plainly = lm.log10_of_bits(one.probability(slots, gate), bit, token, len(symbol))
    assert np.allclose(head.log10(symbol, text, tail, many), plainly, rtol=1e-12)
    words = [b"abc", b"abd", b"", b"\xc3\xa9abc", b"abc"]
    spelling, mixer = lm.Spelling(code), BitMixer(lm.Spelling.CONTEXTS, lm.Spelling.GATES)
    mixer.learn(*spelling.shared_bits(words, mixer)[:3])
    slots, gate, bit, word, _ = spelling.bits(words, mixer)
    lp, of, nth = spelling.log10(words, mixer)
    assert nth.tolist() == [i for w in words for i in range(len(w) + 1)]
    assert np.allclose(np.bincount(of, lp), lm.log10_of_bits(mixer.probability(slots, gate), bit, word, len(words)), rtol=1e-12)


def test_rare_words_are_counted_where_they_are_dealt(docs, rows):
    """Sums over the rare words of each row, of all tasks' slices, against plain counting."""
    spread = docs.repartition(5).select("doc_id", F.monotonically_increasing_id().alias("row"),
                                        F.coalesce("text", F.lit("")).alias("text"),
                                        F.expr(f"not ({lm.HELD_OUT.format(key='doc_id')})").alias("train"))
    counts = lm.word_counts(spread).cache()
    code = lm.make_code(counts, head=5)
    rare = counts.where(~F.col("word").isin([lm.END, *code.words]))
    spelling, mixer = lm.train_spelling(rare, code), lm.train_head(spread, code)
    alone = {r["row"]: r["own"] for r in lm.changes(lm.head_scores(spread, code, mixer)).collect()}
    got = {r["row"]: r for r in lm.changes(lm.head_scores(spread, code, mixer, spelling)).collect()}
    of = {r["word"]: r for r in lm.rare_words(rare, code, spelling).collect()}
    c = {r["word"]: r["c"] for r in rare.collect()}
    assert len(got) == len(rows) and any(n == 0 for n in c.values()) and any(n > 1 for n in c.values())
    for r in spread.collect():
        words = [w for w in plain.words(r["text"]) if w in of]
        g = got[r["row"]]
        assert g["known"] == sum(c[w] > 0 for w in words)
        assert g["base"] == pytest.approx(sum(math.log10((c[w] + 1) / (code.total + code.distinct + 1)) for w in words), abs=1e-6)
        assert g["own"] - alone[r["row"]] == pytest.approx(sum(of[w]["own"] for w in words), rel=1e-6, abs=1e-4)


def test_packed_words_come_back():
    words = pa.array([b"x", "é😀".encode(), b"yy", b"", b"zz"], pa.binary())
    part, of, n = np.array([3, 1, 3, 1, 0]), np.array([0, 3, 70_000, 5, 1]), np.array([1, 300, 2, 1, 9])
    got = [(at, *x) for at, data in lm.dealt_words(part, words, of, n) for x in zip(*(c.tolist() for c in lm.undealt_words(data)))]
    assert sorted(got) == sorted(zip(part.tolist(), words.to_pylist(), of.tolist(), n.tolist()))


def held_bytes(work) -> int:
    """Most bytes that a call holds at once."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_counting_behind_pairs_holds_few_bytes_a_token():
    rng, n, symbols = np.random.default_rng(8), 50_000, 5_000
    def slice_of(row):
        key = rng.integers(0, 300, n) * symbols + rng.zipf(1.3, n) % symbols
        return [(row, data) for _, data in lm.dealt(np.zeros(n, np.int32), key, rng.integers(0, 600, n), -3 * rng.random(n))]
    held = [x for i in range(8) for x in slice_of(1000 * i)]
    tokens = [(row, *lm.uncolumns(data, "<i8", "<u4", "<f4")) for row, data in held]
    got, given = [], list(held)
    assert held_bytes(lambda: got.extend(lm.behind_pairs(given, symbols))) < 60 * 8 * n
    assert not given and [r for r, _ in got] == [r for r, _ in held]
    keys = [np.cumsum(t[1]).tolist() for t in tokens]
    c, total, kinds = Counter(), Counter(), Counter()
    for key, (_, _, of, _) in zip(keys, tokens):
        c.update(k for k, o in zip(key, of.tolist()) if o & 1)
    for k, m in c.items():
        total[k // symbols] += m
        kinds[k // symbols] += 1
    for key, (_, _, of, lp), (_, data) in zip(keys, tokens, got):
        want = Counter()
        for k, o, q in zip(key, of.tolist(), lp.tolist()):
            t = total[k // symbols]
            want[o >> 1] += math.log10((max(c[k] - lm.PAIR_D, 0) + lm.PAIR_D * kinds[k // symbols] * 10 ** q) / t) - q if t else 0.0
        texts, change = lm.uncolumns(data, "<u4", "<f4")
        assert change.tolist() == pytest.approx([want[t] for t in texts.tolist()], rel=1e-4, abs=1e-4)


def test_learning_holds_few_bytes_a_bit():
    words = [f"w{i}" for i in range(400)]
    code, rng = small_code(words), np.random.default_rng(9)
    head, mixer = lm.HeadBits(code), BitMixer(lm.HeadBits.CONTEXTS, lm.HeadBits.GATES, slot_bits=12)
    given = pa.array([" ".join(rng.choice(words[:60], 500)) for _ in range(400)])
    symbol, text, _, tail = head.symbols(split_words(given))
    bits = int(np.diff(code.bounds)[symbol].sum())
    most = held_bytes(lambda: mixer.learn(*head.shared_bits(symbol, text, tail, mixer)[:3]))
    assert bits > 1_000_000 and most < 40 * bits


def test_states_are_sent_as_planes_of_bytes():
    rng, m = np.random.default_rng(10), BitMixer(1, 1, slot_bits=16)
    for _ in range(3):
        n = 60_000
        m.learn([rng.zipf(1.2, n) % (1 << 16)], np.zeros(n, np.int64), rng.integers(0, 2, n))
    rows = [(p, raw) for p, raw in m.rows() if p >= 0]
    pages = m.counts.reshape(-1, 2 * BitMixer.PAGE)
    assert all((BitMixer.add(p, raw, None) == pages[p]).all() for p, raw in rows)
    assert sum(len(raw) for _, raw in rows) < 0.85 * sum(len(lm.squeeze(pages[p])) for p, _ in rows)
