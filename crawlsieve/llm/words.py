"""Words and word shingles of an Arrow batch of texts, as numpy arrays.

A word is a run of characters outside `[\\x20\\x09-\\x0D]` after A-Z are
lower-cased.  Every distinct word of a batch is looked at once (Arrow
dictionary), so per-word Python work follows the distinct words, not the text.
Null counts as an empty text; an empty text has no words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

# fixed values: odd 64-bit multipliers and the two mixing multipliers of the
# public-domain splitmix64 generator
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
HASH_KEY = "crawlsieve-words"  # 16 bytes, pandas' siphash key


@dataclass
class Words:
    """Distinct words, the code of each word in order, and document bounds."""
    vocab: pa.Array        # distinct words
    codes: np.ndarray      # int64, code of every word, documents one after another
    bounds: np.ndarray     # int64, n_docs + 1 offsets into codes

    @property
    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def split_words(texts: pa.Array, lower: bool = True) -> Words:
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    doc = np.repeat(np.arange(len(counts)), counts)
    keep = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not keep.all():  # leading or trailing blanks split off an empty string
        flat, doc = flat.filter(pa.array(keep)), doc[keep]
    enc = flat.dictionary_encode()
    bounds = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.bincount(doc, minlength=len(counts)), out=bounds[1:])
    return Words(enc.dictionary, enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a bijection on 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_2
    return x ^ (x >> np.uint64(31))


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hash of each string, the same in every process."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    values = words.to_numpy(zero_copy_only=False)
    return pd.util.hash_array(values, hash_key=HASH_KEY, categorize=False)


def shingle_hashes(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every k-word shingle in order.  A document with
    fewer words has one shingle, its whole sequence; without words, none."""
    h = hash_words(w.vocab)[w.codes] if len(w.codes) else np.zeros(0, np.uint64)
    doc, n = w.doc_of, len(w.codes)
    ends = w.bounds[1:][doc] if n else np.zeros(0, np.int64)
    starts = np.flatnonzero(np.arange(n) + k <= ends)
    acc = np.full(len(starts), np.uint64(k))
    for j in range(k):
        acc = mix64(acc * GOLDEN + h[starts + j])
    out, out_doc = acc, doc[starts]
    sizes = np.diff(w.bounds)
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(short):
        extra = []
        for d in short:
            a = np.uint64(sizes[d])
            for x in h[w.bounds[d]:w.bounds[d + 1]]:
                a = mix64(np.array([a], np.uint64) * GOLDEN + x)[0]
            extra.append(a)
        out = np.concatenate([out, np.array(extra, np.uint64)])
        out_doc = np.concatenate([out_doc, short])
        order = np.argsort(out_doc, kind="stable")
        out, out_doc = out[order], out_doc[order]
    return out, out_doc


def distinct_shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As `shingle_hashes`, each document's distinct hashes in ascending order."""
    h, doc = shingle_hashes(w, k)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[first], doc[first]
