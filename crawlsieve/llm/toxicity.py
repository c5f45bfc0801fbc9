"""Toxicity by a factorization machine over hashed terms (operator 6).

A text's terms are its distinct words (lower-cased, without marks at either end)
and the first letters of longer words, so that inflected forms meet.  Terms are
hashed to 2^18 buckets; the `terms` buckets that differ most between the classes
(chi-square) are inputs.  The model

    logit = bias + sum w_i + sum_{i<j} <v_i, v_j>

has a linear weight and a `rank`-long vector per term, so a pair such as an insult
and a group mention can weigh more, or less, than its parts.

Fitting uses a bounded sample: the `sample_rows` labelled rows with the smallest
hash of their id (documented parameter, 20,000), out of the training fold only.  Their ids
are the one thing broadcast; the texts are found in one scan and only their hashed
terms are gathered.  Scoring is one scan of all whole texts without a shuffle.

Defined cases: a null text is empty; an empty text gets the model's bias; a null
or repeated label row is skipped or counted like any other; where the sample lacks a
class, every score is the smoothed share of toxic rows; an empty table has no
rows; label, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsieve.llm.common import SLICE_BYTES, register, stored, table
from crawlsieve.llm.words import hash_words, mix64, split_words

BUCKET_BITS = 18
PREFIXES = (4, 5)
TERMS = 512
SAMPLE_ROWS = 20_000
RANK = 4
LEAST_ROWS = 3            # rows of the sample that a term occurs in
THRESHOLD = 0.3
MARKS = string.punctuation + "«»“”‘’…"
TRAINING = "coalesce(crc32(cast(cast({key} as string) as binary)), 0) % 4 <> 2"


def term_buckets(texts: pa.Array, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every distinct term of each text; with `chosen` (bucket ->
    input or -1) only chosen buckets, as inputs."""
    w = split_words(texts, lower=False)
    words = pc.utf8_trim(pc.utf8_lower(w.vocab), MARKS)
    kinds = [words, *(pc.utf8_slice_codeunits(words, 0, p) for p in PREFIXES)]
    doc_of, texts_out, buckets_out = w.doc_of, [], []
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for i, kind in enumerate(kinds):
        enc = kind.dictionary_encode()
        with np.errstate(over="ignore"):
            h = mix64(hash_words(enc.dictionary) + np.uint64(i))
        bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)[enc.indices.to_numpy(zero_copy_only=False)]
        bucket[lengths <= (PREFIXES[i - 1] if i else 0)] = -1
        if chosen is not None:
            bucket = np.where(bucket < 0, -1, chosen[bucket])
        of = bucket[w.codes] if len(w.codes) else np.zeros(0, np.int64)
        use = np.flatnonzero(of >= 0)
        texts_out.append(doc_of[use])
        buckets_out.append(of[use])
    pair = np.unique(np.concatenate(texts_out) << BUCKET_BITS | np.concatenate(buckets_out))
    return pair >> BUCKET_BITS, pair & ((1 << BUCKET_BITS) - 1)


@dataclass
class Machine:
    """Parameters; `chosen` maps a bucket to its input or -1."""
    chosen: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def logits(self, text: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        out = self.bias + np.bincount(text, self.weights[term], n)
        for v in self.vectors.T:
            x = v[term]
            out += 0.5 * (np.bincount(text, x, n) ** 2 - np.bincount(text, x * x, n))
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        text, term = term_buckets(texts, self.chosen)
        return sigmoid(self.logits(text, term, len(texts)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def fit(row: np.ndarray, term: np.ndarray, label: np.ndarray, n_terms: int, rank: int = RANK, epochs: int = 30,
        rate: float = 0.1, penalty: float = 0.3, batch: int = 256, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss by AdaGrad; (row, term) are pairs sorted by row."""
    rng, n = np.random.default_rng(seed), len(label)
    w, v = np.zeros(n_terms), rng.normal(0.0, 0.01, (n_terms, rank))
    share = (label.sum() + 1.0) / (n + 2.0)
    bias, gw, gv, gb = float(np.log(share / (1.0 - share))), np.full(n_terms, 1e-8), np.full((n_terms, rank), 1e-8), 1e-8
    bounds = np.searchsorted(row, np.arange(n + 1))
    for _ in range(epochs):
        order = rng.permutation(n)
        for start in range(0, n, batch):
            rows = order[start:start + batch]
            sizes = bounds[rows + 1] - bounds[rows]
            ends = np.cumsum(sizes)
            at = np.repeat(bounds[rows] - (ends - sizes), sizes) + np.arange(int(ends[-1]))
            of, t = np.repeat(np.arange(len(rows)), sizes), term[at]
            sums = np.stack([np.bincount(of, v[t, f], len(rows)) for f in range(rank)], 1)
            squares = np.bincount(of, (v[t] ** 2).sum(1), len(rows))
            logit = bias + np.bincount(of, w[t], len(rows)) + 0.5 * ((sums ** 2).sum(1) - squares)
            error = (sigmoid(logit) - label[rows]) / len(rows)
            dw = np.bincount(t, error[of], n_terms) + penalty * w / n
            slope = error[of, None] * (sums[of] - v[t])
            dv = np.stack([np.bincount(t, slope[:, f], n_terms) for f in range(rank)], 1) + penalty * v / n
            db = float(error.sum())
            gw, gv, gb = gw + dw * dw, gv + dv * dv, gb + db * db
            w -= rate * dw / np.sqrt(gw)
            v -= rate * dv / np.sqrt(gv)
            bias -= rate * db / np.sqrt(gb)
    return bias, w, v


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          sample_rows: int = SAMPLE_ROWS, terms: int = TERMS) -> Machine:
    """Fits on labelled rows of the training fold."""
    usable = (labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
              .where("doc_id is not null and label is not null").where(TRAINING.format(key="doc_id")))
    sample = stored(usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows), "sample")
    # at most `sample_rows` rows of two numbers
    found = (docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
             .join(F.broadcast(sample), "doc_id"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                row, bucket = term_buckets(part.column(1))
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(bucket.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), lists], names=["doc_id", "label", "buckets"])

    rows = stored(found.select("doc_id", "text", "label").mapInArrow(hashed, "doc_id long, label int, buckets array<int>"), "terms")
    counts = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    n, toxic = counts["n"], counts["toxic"]
    chosen = np.full(1 << BUCKET_BITS, -1, np.int64)
    if not toxic or toxic == n:
        share = (toxic + 1.0) / (n + 2.0)
        return Machine(chosen, float(np.log(share / (1 - share))) if n else 0.0, np.zeros(1), np.zeros((1, RANK)))
    a, b = F.col("toxic"), F.col("all") - F.col("toxic")
    c, d = F.lit(toxic) - a, F.lit(n - toxic) - b
    chi = n * F.pow(a * d - b * c, 2) / ((a + b).cast("double") * (c + d + 1) * toxic * (n - toxic))
    best = (rows.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket")
            .agg(F.sum("label").alias("toxic"), F.count("*").alias("all")).where(F.col("all") >= LEAST_ROWS)
            .orderBy(F.round(chi, 6).desc(), "bucket").limit(terms).select("bucket"))
    buckets = sorted(r["bucket"] for r in best.collect())       # at most `terms`
    chosen[buckets] = np.arange(len(buckets))
    picked = rows.select("doc_id", "label", F.array_intersect("buckets", F.array(*map(F.lit, buckets))).alias("buckets"))
    given = sorted(picked.collect(), key=lambda r: (r["doc_id"], r["label"], r["buckets"]))   # at most `sample_rows`
    row = np.repeat(np.arange(len(given)), [len(r["buckets"]) for r in given])
    term = chosen[np.array([x for r in given for x in r["buckets"]], np.int64)]
    order = np.lexsort((term, row))
    bias, w, v = fit(row[order], term[order], np.array([r["label"] for r in given], float), len(buckets))
    return Machine(chosen, bias, w, v)


def score_column(model: Machine, spark):
    """An Arrow function: text column -> score."""
    sent = spark.sparkContext.broadcast(model)    # 2^18 numbers and `terms` vectors

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            step = max(1, int(len(sizes) * SLICE_BYTES / max(1, sizes.sum())))
            done = [sent.value.scores(texts.slice(i, step)) for i in range(0, len(texts), step)]
            yield pa.array(np.concatenate(done) if done else np.zeros(0))

    return score


def score_documents(docs: DataFrame, model: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted per row."""
    score = score_column(model, docs.sparkSession)
    return (docs.select(F.col(key), F.expr(f"not ({TRAINING.format(key=f'`{key}`')})").alias("held_out"),
                        score(F.col(text)).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that the model does not reject."""
    score = score_column(train(docs, labels, key, text), docs.sparkSession)
    return docs.where(score(F.col(text)) < THRESHOLD)


@register("op6_toxicity_fm")
def op6_toxicity_fm(spark, sf_dir):
    """A toxicity score for every text of `documents`."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
