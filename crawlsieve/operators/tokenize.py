"""Tokenization.

Sub-word ids with ``[CLS] ... [SEP]``, truncated to ``max_tokens``, via
the ``tokenizers`` library (WordPiece + BERT normaliser / pre-tokenizer).
The vocabulary is caller-supplied; ``fit_vocab`` derives one from a text
column with Spark (word counts, then the top-N words: a top-k report
whose size is the vocabulary size, so the broadcast is bounded by N).

The tokenizer is built once per Python worker (cached by vocabulary
digest) and applied to whole Arrow batches with ``encode_batch``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsieve.sources.ranged import work_partitions

# Special tokens, and the single characters every vocabulary holds.
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
BASE_CHARS = list("abcdefghijklmnopqrstuvwxyz0123456789") + list(".,;:!?'\"-()[]{}/&%$#@*+=<>_|~^`\\")

_CACHE: dict[str, object] = {}


def vocab_from_words(words: list[str]) -> list[str]:
    seen = set()
    out = []
    for t in SPECIAL_TOKENS + BASE_CHARS + ["##" + c for c in BASE_CHARS] + list(words):
        if t not in seen:
            seen.add(t)
            out.append(t)
    return out


def fit_vocab(df: DataFrame, text: str = "text", size: int = 8000) -> list[str]:
    """Top ``size`` lower-cased words by count (ties: word ascending)."""
    # dealt out first: a file of one row group would be split by one task alone
    texts = df.select(F.col(text).alias("text")).repartition(work_partitions(df.sparkSession))
    words = (texts.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("w"))
               .where(F.length("w") > 1)
               .groupBy("w").count()
               .orderBy(F.desc("count"), F.asc("w"))
               .limit(size))
    return vocab_from_words([r.w for r in words.collect()])


def load_vocab(spark, vocab) -> list[str]:
    """Vocabulary as a token list (id = position) from a list, a dict
    ``token -> id``, or a path to a one-token-per-line file on any Hadoop
    file system (read whole, so line order is kept; bounded by its size)."""
    if isinstance(vocab, (list, tuple)):
        return list(vocab)
    if isinstance(vocab, dict):
        ordered = sorted(vocab.items(), key=lambda kv: kv[1])
        if [i for _, i in ordered] != list(range(len(ordered))):
            raise ValueError("vocabulary ids must be 0..n-1")
        return [t for t, _ in ordered]
    text = spark.read.text(str(vocab), wholetext=True).first()[0]
    return [line.rstrip("\r") for line in text.split("\n") if line.strip()]


def _digest(vocab: list[str]) -> str:
    return hashlib.sha1("\n".join(vocab).encode("utf-8")).hexdigest()


def build_tokenizer(vocab: list[str], max_tokens: int = 512):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, processors

    key = f"{_digest(vocab)}:{max_tokens}"
    tok = _CACHE.get(key)
    if tok is None:
        ids = {t: i for i, t in enumerate(vocab)}
        tok = Tokenizer(models.WordPiece(ids, unk_token="[UNK]", max_input_chars_per_word=100))
        tok.normalizer = normalizers.BertNormalizer(clean_text=True, handle_chinese_chars=True,
                                                    strip_accents=True, lowercase=True)
        tok.pre_tokenizer = pre_tokenizers.BertPreTokenizer()
        tok.post_processor = processors.TemplateProcessing(
            single="[CLS] $A [SEP]", special_tokens=[("[CLS]", ids["[CLS]"]), ("[SEP]", ids["[SEP]"])])
        tok.enable_truncation(max_length=max_tokens)
        _CACHE[key] = tok
    return tok


def tokenize(df: DataFrame, vocab, text: str = "full_text", out: str = "tokens",
             max_tokens: int = 512, keep_errors: bool = False) -> DataFrame:
    """Add ``tokens array<int>``; rows whose text cannot be tokenized are
    dropped (or kept with NULL tokens and ``token_error`` set when
    ``keep_errors``).  ``vocab``: list, dict or file path (``load_vocab``)."""
    vocab = load_vocab(df.sparkSession, vocab)
    bvocab = df.sparkSession.sparkContext.broadcast(vocab)
    fields = list(df.schema.fields) + [T.StructField(out, T.ArrayType(T.IntegerType()))]
    if keep_errors:
        fields.append(T.StructField("token_error", T.StringType()))
    schema = T.StructType(fields)

    def run(batches):
        import os

        import pyarrow as pa
        # Spark already runs one task per core: keep the library's own
        # thread pool off so workers do not oversubscribe the executor.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tok = build_tokenizer(bvocab.value, max_tokens)
        for b in batches:
            texts = b.column(text).to_pylist()
            ids, errs = [], []
            try:
                enc = tok.encode_batch([t if t is not None else "" for t in texts])
                ids = [e.ids for e in enc]
                errs = [None if t is not None else "NullText" for t in texts]
            except Exception:  # fall back to one-by-one to isolate bad rows
                for t in texts:
                    try:
                        ids.append(tok.encode(t).ids)
                        errs.append(None)
                    except Exception as e:  # noqa: BLE001
                        ids.append(None)
                        errs.append(type(e).__name__)
            ids = [None if e else i for i, e in zip(ids, errs)]
            cols = [b.column(i) for i in range(b.num_columns)] + [pa.array(ids, type=pa.list_(pa.int32()))]
            names = list(b.schema.names) + [out]
            if keep_errors:
                cols.append(pa.array(errs, type=pa.string()))
                names.append("token_error")
            rb = pa.RecordBatch.from_arrays(cols, names=names)
            if not keep_errors:
                rb = rb.filter(pa.array([e is None for e in errs]))
            yield rb

    return df.mapInArrow(run, schema)


def tokenization_errors(df: DataFrame) -> DataFrame:
    """Counter of failed tokenizations (needs ``keep_errors=True`` output)."""
    return df.agg(F.count_if(F.col("token_error").isNotNull()).cast("bigint").alias("tokenization_errors"))
