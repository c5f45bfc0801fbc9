"""Token counts of every prefix (operator 12).

For a byte-pair vocabulary whose every token encodes to itself, a sequence of tokens
is the encoding of its text exactly when each two neighbours are the encoding of
theirs.  So one pass over the bytes of a piece finds, for every prefix, its only
possible last token t: one whose predecessor, the last token of the prefix that t
leaves, may stand before t.  Then count(prefix) = count(prefix without t) + 1.

A text is cut into units at places where the tokenizer always cuts; the counts of a
prefix are the tokens of the units before it plus the count inside its unit, so
the dynamic programme runs once per distinct unit of a Python worker (bounded memo).
Short units that are one piece are taken together, a byte of all of them at a time, with
numpy (`Lockstep`); the others one by one.
What a longer text changes inside a unit is set right per prefix: a prefix that ends
with a run of blanks holds that run as one piece, a cut contraction is two pieces, a
cut special token is ordinary text.

The store holds, for every text, the difference of the counts of neighbouring
prefixes, one signed byte per character.  `fitting_prefixes` (the longest prefix
within a budget) and `tokens_at` (the count of a prefix) read the store alone.

Defined cases: a null text is empty and has no tokens; repeated rows and ids give a
row each; the key column may hold anything; an empty table has no rows; other
columns are not read.  Special tokens inside texts are what the library takes them for.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsieve.llm.common import register, slices, stored, table
from crawlsieve.llm.encode import tokenizer_file

FILE = "byte_bpe_50k.json"
LIMIT = 1024
MEMO_UNITS = 800_000
MEMO_PAIRS = 2_000_000
LONG_UNIT = 64          # longer units are not remembered
# fixed values: odd 64-bit multipliers (golden ratio, splitmix64's mixers)
MULTIPLIERS = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
SHARED = (9, 6, 4)      # lengths at which the states of a piece are remembered
MEMO_STATES = 200_000
SLICE = 4 << 20

# fixed values: Unicode's White_Space characters
BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters and other signs of which every version of Unicode since 6.0 says the same.
LETTER = ("A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02c1\u0391-\u03a1\u03a3-\u03e1\u0410-\u044f"
          "\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3")
OTHER = "!-/:-@\\[-`{-~\xa1-\xa9\xab\xac\xae-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7\u2010-\u2027\u2030-\u205e\u20a0-\u20b5"
PLAIN = re.compile(f"[{BLANK}{LETTER}0-9{OTHER}]*")
# Units of plain texts, and of any text (cut before blanks only).
UNITS = re.compile(f"(?:[{BLANK}]*[{BLANK.replace(' ', '')}])?'(?:[stmd]|re|ve|ll)|[{BLANK}]*(?:[{LETTER}]+|[0-9]+|[{OTHER}]+)|[{BLANK}]+")
ONE_PIECE = re.compile(f" ?(?:[{LETTER}]+|[0-9]+|[{OTHER}]+)")
ANY_UNITS = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
BLANKS = re.compile(f"[{BLANK}]+")
BYTE_LETTERS = dict(zip([b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or 174 <= b)], range(256, 400)))
CONTRACTIONS = ("'re", "'ve", "'ll")    # fixed values: those that a prefix can cut


class Lockstep:
    """The dynamic programme over many pieces of at most `WIDTH` bytes at a time.

    Tokens lie in a hash table keyed by their bytes, as two 64-bit words and a length."""

    WIDTH, BITS = 16, 18

    def __init__(self, token_bytes: list[tuple[int, bytes]], meet):
        self.meet = meet                        # (a, b) -> whether token b may follow token a
        size = 1 << self.BITS
        self.low, self.high = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.length, self.token = np.zeros(size, np.uint8), np.full(size, -1, np.int64)
        for token, data in token_bytes:
            if len(data) <= self.WIDTH:
                low, high = int.from_bytes(data[-8:], "big"), int.from_bytes(data[:-8], "big")
                at = int(self._slot(np.array([low], np.uint64), np.array([high], np.uint64), len(data))[0])
                while self.length[at]:
                    at = (at + 1) % size
                self.low[at], self.high[at], self.length[at], self.token[at] = low, high, len(data), token
        self.known = [np.zeros(0, np.int64), np.zeros(0, np.int64)]     # sorted 2 * pair + answer: old, of this call

    def _slot(self, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
        h = (low + np.uint64(length)) * MULTIPLIERS[0] ^ high * MULTIPLIERS[1]
        return ((h ^ (h >> np.uint64(29))) * MULTIPLIERS[2] >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
        """Token of these bytes; -1 where there is none."""
        out, rows = np.full(len(low), -1, np.int64), np.arange(len(low))
        at = self._slot(low, high, length)
        while len(rows):
            hit = (self.length[at] == length) & (self.low[at] == low) & (self.high[at] == high)
            out[rows[hit]] = self.token[at[hit]]
            on = ~hit & (self.length[at] != 0)
            rows, low, high, at = rows[on], low[on], high[on], (at[on] + 1) & ((1 << self.BITS) - 1)
        return out

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = (a << 17 | b) << 1
        out, unknown = np.zeros(len(pair), bool), np.ones(len(pair), bool)
        for known in self.known:
            if len(known):
                at = np.minimum(np.searchsorted(known, pair), len(known) - 1)
                hit = known[at] >> 1 == pair >> 1
                out[hit] = known[at[hit]] & 1
                unknown &= ~hit
        if unknown.any():
            fresh, where = np.unique(pair[unknown], return_inverse=True)
            answer = np.fromiter((self.meet(p >> 18, p >> 1 & 0x1FFFF) for p in fresh.tolist()), np.int64, len(fresh))
            out[unknown] = answer[where]
            self.known[1] = np.sort(np.concatenate([self.known[1], fresh | answer]))
        return out

    def counts(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces x (longest + 1)) counts after each byte, and which of those places are
        ends of characters."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-lengths, kind="stable")
        lengths, n, width = lengths[order], len(pieces), int(lengths.max())
        letters = np.zeros((n, width), np.uint8)
        letters[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join([pieces[i] for i in order]), np.uint8)
        count, last = np.zeros((n, width + 1), np.int16), np.full((n, width + 1), -1, np.int64)
        low, high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        for end in range(1, width + 1):
            rows = np.arange(int(np.searchsorted(-lengths, -end, side="right")))
            high = (high << np.uint64(8)) | (low >> np.uint64(56))
            low = (low << np.uint64(8)) | letters[:, end - 1]
            for length in range(1, end + 1):
                mask = [np.uint64((1 << 8 * min(max(length - k, 0), 8)) - 1) for k in (0, 8)]
                token = self.find(low[rows] & mask[0], high[rows] & mask[1], length)
                fits = token >= 0
                if length < end:
                    some = np.flatnonzero(fits)
                    fits[some] = self.follows(last[rows[some], end - length], token[some])
                done = rows[fits]
                count[done, end] = count[done, end - length] + 1
                last[done, end] = token[fits]
                rows = rows[~fits]
                if not len(rows):
                    break
            else:
                raise ValueError(f"no token of the vocabulary ends at byte {end} of {pieces[order[rows[0]]]!r}")
        self.known = [np.sort(np.concatenate(self.known)), np.zeros(0, np.int64)]
        if len(self.known[0]) > MEMO_PAIRS:
            self.known[0] = np.zeros(0, np.int64)
        ends = np.arange(width + 1) <= lengths[:, None]
        ends[:, 1:width] &= (letters[:, 1:] & 0xC0) != 0x80
        back = np.argsort(order)
        return count[back], ends[back]


class PrefixCounter:
    """Counts of all prefixes, for one byte-level tokenizer file."""

    def __init__(self, file: str, memo_units: int = MEMO_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(file)
        self.cut, self.model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError("special tokens that take part of their surroundings are not supported")
        self.special = sorted((t.content for t in added.values()), key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.name = {i: t for t, i in self.vocab.items()}
        self.longest = max(map(len, self.vocab))
        if self.longest > 128:
            raise ValueError("a token of more than 128 bytes: differences no longer fit a byte")
        self.pairs: dict[tuple[int, int], bool] = {}
        self.states: dict[str, tuple[tuple, tuple]] = {}
        letter_byte = {c: b for b, c in enumerate(bytes(range(256)).decode("latin-1").translate(BYTE_LETTERS))}
        self.lockstep = Lockstep([(i, bytes(letter_byte[c] for c in t)) for t, i in self.vocab.items()], self._follows)
        self.most = memo_units
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.sizes = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int8)

    def _meet(self, a: int, b: int) -> bool:
        """Whether token b may follow token a."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self._follows(a, b)
            self.pairs[a, b] = known
        return known

    def _follows(self, a: int, b: int) -> bool:
        return [t.id for t in self.model.tokenize(self.name[a] + self.name[b])] == [a, b]

    def piece(self, piece: str) -> list[int]:
        """Counts of the prefixes (in byte letters) of one piece, the empty one first."""
        vocab, met = self.vocab.get, self.pairs.get
        counts, last = [0], [-1]
        for upto in SHARED:                     # pieces that begin alike share their first states
            known = self.states.get(piece[:upto]) if upto <= len(piece) else None
            if known is not None:
                counts, last = [*known[0]], [*known[1]]
                break
        for end in range(len(counts), len(piece) + 1):
            for at in range(end - 1, max(end - self.longest, 0) - 1, -1):
                token = vocab(piece[at:end])
                if token is not None and (at == 0 or met((last[at], token)) or self._meet(last[at], token)):
                    counts.append(counts[at] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token of the vocabulary ends at byte {end} of {piece!r}")
            if end in SHARED:
                if len(self.states) >= MEMO_STATES:
                    self.states.clear()
                self.states[piece[:end]] = tuple(counts), tuple(last)
        return counts

    def unit(self, text: str) -> list[int]:
        """Counts of the prefixes of a text without special tokens, the empty one first."""
        if ONE_PIECE.fullmatch(text):
            counts = self.piece(text.encode().decode("latin-1").translate(BYTE_LETTERS))
            return counts if text.isascii() else [counts[i] for i in accumulate((len(c.encode()) for c in text), initial=0)]
        out, base, run = [0], 0, None
        for letters, (start, end) in self.cut.pre_tokenize_str(text):
            part = text[start:end]
            at_bytes = self.piece(letters)
            if len(letters) == len(part):
                counts = at_bytes
            else:
                counts = [0, *(at_bytes[i] for i in np.cumsum([len(c.encode()) for c in part]))]
            if part in CONTRACTIONS:
                counts = [*counts]
                counts[2] = counts[1] + self.piece(letters[1:2])[1]
            out.extend(base + c for c in counts[1:])
            if run is not None and BLANKS.match(part):       # the prefix that ends after these blanks
                before, blanks = run
                pieces = self.cut.pre_tokenize_str(blanks + part[0])
                out[start + 1] = before + sum(self.piece(p)[-1] for p, _ in pieces)
            run = (base, part) if BLANKS.fullmatch(part) else None
            base += counts[-1]
        return out

    def _fresh(self, units: list[str]) -> None:
        short, other, data = [], [], []
        for u in units:
            b = u.encode()
            if len(b) <= Lockstep.WIDTH and ONE_PIECE.fullmatch(u):
                short.append(u)
                data.append(b)
            else:
                other.append(u)
        if short:
            counts, ends = self.lockstep.counts(data)
            self._add(short, counts[ends].astype(np.int64), ends.sum(axis=1))
        if other:
            counts = [self.unit(u) for u in other]
            upto = np.fromiter(map(len, counts), np.int64, len(counts))
            self._add(other, np.fromiter(chain.from_iterable(counts), np.int64, int(upto.sum())), upto)

    def _add(self, units: list[str], counts: np.ndarray, upto: np.ndarray) -> None:
        """Remember units by their counts, one after another, `upto` of each."""
        self.place.update(zip(units, range(len(self.sizes), len(self.sizes) + len(units))))
        diffs = np.diff(counts, append=0)
        keep = np.ones(len(diffs), bool)
        keep[np.cumsum(upto) - 1] = False       # from the end of a unit to the start of the next
        sizes = upto - 1
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, diffs[keep].astype(np.int8)])

    def _ordinary(self, texts: list[str]) -> list[np.ndarray]:
        """Differences of the counts, of texts without special tokens."""
        cut = [(UNITS if PLAIN.fullmatch(t) else ANY_UNITS).findall(t) for t in texts]
        enc = pa.array(chain.from_iterable(cut), pa.string()).dictionary_encode()
        units, codes = enc.dictionary.to_pylist(), enc.indices.to_numpy(zero_copy_only=False)
        bounds = np.cumsum([0, *map(len, cut)])
        if max(map(len, units), default=0) > LONG_UNIT:
            return [self._with_long(us) for us in cut]
        all_, upto = self._remembered(units, codes)
        return [all_[a:b] for a, b in zip(upto[bounds[:-1]], upto[bounds[1:]])]

    def _with_long(self, units: list[str]) -> np.ndarray:
        parts, held = [], []
        for u in [*units, None]:
            if u is not None and len(u) <= LONG_UNIT:
                held.append(u)
                continue
            names = list(dict.fromkeys(held))
            place = {h: i for i, h in enumerate(names)}
            parts.append(self._remembered(names, np.array([place[h] for h in held], np.int64))[0])
            held = []
            if u is not None:
                parts.append(np.diff(self.unit(u)).astype(np.int8))
        return np.concatenate(parts)

    def _remembered(self, units: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Differences of distinct units as they follow one another, and where each begins and ends."""
        found = list(map(self.place.get, units))
        fresh = [u for u, f in zip(units, found) if f is None]
        if fresh:
            if len(self.place) + len(fresh) > self.most:
                self._forget()                      # the memo stays bounded
                fresh = units
            self._fresh(fresh)
            found = list(map(self.place.__getitem__, units))
        rows = np.array(found, np.int64)[codes]
        n = self.sizes[rows]
        ends = np.cumsum(n)
        all_ = self.pool[np.repeat(self.starts[rows] - (ends - n), n) + np.arange(int(n.sum()))]
        return all_, np.concatenate([[0], ends])

    def _with_special(self, text: str) -> np.ndarray:
        parts, out = self.split.split(text), []
        for part, special in zip(parts[::2], [*parts[1::2], ""]):
            d = self._ordinary([part + special[:-1]])[0]
            out.append(d)
            if special:
                done = d.astype(np.int64)
                out.append(np.array([1 - int(done[len(part):].sum())], np.int8))
        return np.concatenate(out)

    def differences(self, texts: list[str]) -> list[np.ndarray]:
        """Per text: count(prefix of i + 1 characters) - count(prefix of i characters)."""
        has = [bool(self.split and self.split.search(t)) for t in texts]
        rest = iter(self._ordinary([t for t, h in zip(texts, has) if not h]))
        return [self._with_special(t) if h else next(rest) for t, h in zip(texts, has)]


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(file: str) -> PrefixCounter:
    """The counter of this Python worker (workers are reused between tasks)."""
    if file not in _COUNTERS:
        _COUNTERS[file] = PrefixCounter(file)
    return _COUNTERS[file]


STORE = [T.StructField("n_chars", T.LongType()), T.StructField("n_bytes", T.LongType()),
         T.StructField("n_tokens", T.LongType()), T.StructField("differences", T.BinaryType())]


def prefix_counts(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The store: per row the key, n_chars, n_bytes, n_tokens of the whole text
    and the differences of its prefix counts."""
    if key in {f.name for f in STORE}:
        raise ValueError(f"the key column needs another name than {key!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(file)
        for batch in slices(batches, 1, SLICE):
            texts = batch.column(1).to_pylist()
            diffs = count.differences(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, diffs), pa.int64()),
                 pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array([int(d.sum(dtype=np.int64)) for d in diffs], pa.int64()),
                 pa.array([d.tobytes() for d in diffs], pa.binary())], names=[key, *(f.name for f in STORE)])

    read = docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))
    return read.mapInArrow(run, T.StructType([read.schema[0], *STORE]))


def _per_text(store: DataFrame, read: list, out: T.StructField, answer) -> DataFrame:
    """The store's other columns and one answered from (counts of all prefixes, argument)."""
    keep = [c for c in store.columns if c not in ("differences", out.name)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(keep), SLICE):
            args = batch.column(len(keep) + 1).to_pylist()
            found = [answer(np.concatenate([[0], np.cumsum(np.frombuffer(d, np.int8), dtype=np.int64)]), a)
                     for d, a in zip(batch.column(len(keep)).to_pylist(), args)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(found, pa.int64())],
                                             names=[*keep, out.name])

    rows = store.select(*keep, "differences", read[0])
    return rows.mapInArrow(run, T.StructType([store.schema[c] for c in keep] + [out]))


def fitting_prefixes(store: DataFrame, budget: int, out: str = "fitting_chars") -> DataFrame:
    """The longest prefix, in characters, of at most `budget` tokens.  Counts can
    fall as a prefix grows (two tokens become one), so it is the last that fits."""
    return _per_text(store, [F.lit(int(budget)).alias("_budget")], T.StructField(out, T.LongType()),
                     lambda counts, budget: int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else None)


def tokens_at(store: DataFrame, chars, out: str = "tokens") -> DataFrame:
    """Tokens of the prefix of `chars` characters (a column; null: null; beyond the end: the whole text)."""
    return _per_text(store, [chars.cast("long").alias("_chars")], T.StructField(out, T.LongType()),
                     lambda counts, n: None if n is None or n < 0 else int(counts[min(n, len(counts) - 1)]))


@register("op12_prefix_token_counts")
def op12_prefix_token_counts(spark, sf_dir):
    """Tokens of all `documents`, whether they are over the limit, and the longest prefix within it."""
    store = stored(prefix_counts(table(spark, sf_dir, "documents"), tokenizer_file(FILE)), "prefixes")
    return fitting_prefixes(store, LIMIT).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_bytes", "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"), "fitting_chars")
