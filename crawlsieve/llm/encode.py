"""Token ids of whole texts with a public tokenizer file.

The tokenizer cuts at white space before anything else, so the ids of a text
are the ids of its blank-separated words in order.  Each distinct word of an
Arrow slice is encoded by the library and remembered in a bounded memo of the
Python worker; a text's ids are then gathered with numpy.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from crawlsieve.llm.words import split_words

MEMO_WORDS = 700_000
# Letters whose lower case is one letter and which no normal form changes,
# then marks: two words to the tokenizer.
MARKS = ".,;:!?"
PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+[.,;:!?]*$"


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@dataclass
class TokenIds:
    """Token ids of several texts, one after another."""
    ids: np.ndarray      # uint32
    bounds: np.ndarray   # int64, n_texts + 1 offsets into ids


class Encoder:
    """Encodes Arrow string arrays.  For tokenizers whose ids never depend on
    what lies beyond white space, and that lower-case."""

    def __init__(self, file: str, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.most = memo_words
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}             # word -> row of the tables below
        self.sizes = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _encode(self, word: str, plain: bool) -> list[int]:
        """Ids of one word; plain letters need only the library's byte table
        and its model, anything else goes through the whole tokenizer."""
        if not plain:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        if not word.isascii():
            word = self.bytes.pre_tokenize_str(word)[0][0]
        return [t.id for t in self.model.tokenize(word)]

    def _rows(self, keys: pa.Array, plain: np.ndarray) -> np.ndarray:
        """Table rows of distinct words; `plain` marks lower-cased letters."""
        words = keys.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.place.get, words))
        fresh = [i for i, p in enumerate(found) if p is None]
        if fresh:
            ids = [self._encode(words[i], plain[i]) for i in fresh]
            at = len(self.sizes)
            for k, i in enumerate(fresh, at):
                found[i] = self.place[words[i]] = k
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))])
        return np.array(found, np.int64)

    def encode(self, texts: pa.Array) -> TokenIds:
        w = split_words(texts, lower=False)
        if not len(w.codes):
            return TokenIds(np.zeros(0, np.uint32), np.zeros(len(w.bounds), np.int64))
        if len(self.place) + 2 * len(w.vocab) > max(self.most, 2 * len(w.vocab)):
            self._forget()  # the memo stays bounded
        plain = pc.match_substring_regex(w.vocab, PLAIN)
        stems = pc.if_else(plain, pc.utf8_lower(pc.utf8_rtrim(w.vocab, MARKS)), w.vocab).dictionary_encode()
        of = stems.indices.to_numpy(zero_copy_only=False)
        is_plain = np.zeros(len(stems.dictionary), bool)
        is_plain[of] = plain.to_numpy(zero_copy_only=False)
        rows = np.empty((len(w.vocab), 2), np.int64)
        rows[:, 0] = self._rows(stems.dictionary, is_plain)[of]
        tails = pc.if_else(plain, pc.replace_substring_regex(w.vocab, "^[^.,;:!?]*", ""), "").dictionary_encode()
        rows[:, 1] = self._rows(tails.dictionary, np.zeros(len(tails.dictionary), bool))[
            tails.indices.to_numpy(zero_copy_only=False)]
        rows = rows[w.codes].ravel()
        n = self.sizes[rows]
        ends = np.cumsum(n)
        at = np.repeat(self.starts[rows] - (ends - n), n) + np.arange(int(ends[-1]))
        return TokenIds(self.pool[at], np.concatenate([[0], ends[1::2]])[w.bounds])


_ENCODERS: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    """The encoder of this Python worker (workers are reused between tasks)."""
    if file not in _ENCODERS:
        _ENCODERS[file] = Encoder(file)
    return _ENCODERS[file]


def with_end(t: TokenIds, end_id: int) -> TokenIds:
    """The ids with `end_id` after each text."""
    n = len(t.bounds) - 1
    bounds = t.bounds + np.arange(n + 1)
    ids = np.full(int(bounds[-1]), end_id, np.uint32)
    keep = np.ones(len(ids), bool)
    keep[bounds[1:] - 1] = False
    ids[keep] = t.ids
    return TokenIds(ids, bounds)
