"""Language-model scores by online logistic context mixing (operator 8).

A text is a sequence of words and an end.  Its probability is made of bits:

* The `HEAD` most frequent training words, the end and the `CLASSES` most frequent
  beginnings (three bytes) of all other, rare words have a Huffman code, and so
  has one symbol for rare words that begin otherwise.  Each code bit is predicted
  from several hashed contexts (none, the last symbol, the last letters of the
  word before), mixed by gated weights and refined (`bit_mixer`).
* Behind the last two symbols a symbol has the probability
  `(max(c - PAIR_D, 0) + PAIR_D * V * mixed) / C`, from exact training counts: its own, the pair's
  C and the V distinct symbols that follow it; `mixed` is the product of its bits.
* A rare word behind its class has the probability
  `(max(c - D, 0) + D * V * spelling) / C`: its training count, discounted, among the
  class's C tokens and V distinct words; the discounted share goes to a second mixer
  that spells words byte by byte from hashed letter contexts.

All counts cover every training document.  Word counts are a Spark aggregation
that grows with the input; each rare word of a document is dealt by its hash to a task
that counts and spells it (`behind_classes`).  Its keys cannot be hot, because frequent
words are in the head (at most `HEAD` words, collected and broadcast).  Mixers learn online in every task over
all its training rows, with as many slots as the training rows have contexts (`slot_bits`,
bounded by the symbols and endings, not by rows);
their states are summed in Spark, and every worker holds the sum when scoring.  Scoring is one
more scan, whose per-document sums are joined by row number.  It deals every symbol, with its
mixed probability, by its last two to a task that counts them all (`behind_pairs`).

`base_score` is the add-one unigram of the contract.

Defined cases: a null text is empty and has only the end; without training rows
counts are zero and the mixers predict one half per bit; a null id counts as the
empty text in the fold rule; repeated rows are scored one by one; an empty table
has no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsieve.llm.bit_mixer import SLOT_BITS, BitMixer, Shared, Spread, by_depth
from crawlsieve.llm.common import columns, give_back, register, slices, squeeze, stored, table, uncolumns, unsqueeze
from crawlsieve.llm.words import GOLDEN, Words, hash_words, mix64, split_words

HEAD = 4094                # frequent words with a code of their own
CLASSES = 1023             # beginnings of rare words with a code of their own
BEGIN = 3                  # bytes of a beginning
END = "\n"                 # no word holds a blank
GATE_DEPTH = 12
SLICE = 1 << 20
BLOCK = 1 << 12            # symbols scored at once
SAMPLE = 64                # one hash in so many is counted to size the predictors
HELD_OUT = "coalesce(crc32(cast(cast({key} as string) as binary)), 0) % 7 = 2"
LOG10_2 = math.log10(2.0)
PAIR_D = 0.75              # discount of counts behind two symbols
PAIR_TOKENS = 4_000_000    # training tokens a task counts behind pairs
BINS = 32                  # of pairs in such a task, counted one after another


@dataclass
class Code:
    """Huffman code of the symbols 0 (other rare word), 1 (end), head words, and
    beginnings of rare words."""
    words: list[str]
    begins: list[bytes]
    counts: np.ndarray     # training tokens of the symbols
    types: np.ndarray      # distinct training words of the symbols
    nodes: np.ndarray      # code tree nodes, symbols one after another
    bits: np.ndarray
    bounds: np.ndarray
    total: int             # N, training tokens
    distinct: int          # V, distinct training tokens
    discount: float        # D

    @property
    def first_class(self) -> int:
        return 2 + len(self.words)


def huffman(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, bits, bounds) of the codes; node numbers are those of the tree."""
    heap = [(max(c, 1), i, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    children, fresh = {}, len(counts)
    while len(heap) > 1:
        (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        children[fresh] = (left, right)
        heapq.heappush(heap, (a + b, fresh, fresh))
        fresh += 1
    paths: dict[int, list[tuple[int, int]]] = {}
    stack = [(heap[0][2], [])]
    while stack:
        node, path = stack.pop()
        if node in children:
            stack += [(child, [*path, (node - len(counts), bit)]) for bit, child in enumerate(children[node])]
        else:
            paths[node] = path
    each = [paths[i] for i in range(len(counts))]
    flat = [step for p in each for step in p]
    return (np.array([n for n, _ in flat], np.int64), np.array([b for _, b in flat], np.int64),
            np.concatenate([[0], np.cumsum([len(p) for p in each])]).astype(np.int64))


def gather(bounds: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place) that lay out the ranges of the items `of` one after another."""
    sizes = bounds[of + 1] - bounds[of]
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(of)), sizes)
    return owner, np.repeat(bounds[of] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def pairs(bounds: np.ndarray, nodes: np.ndarray, symbol: np.ndarray, contexts: list[np.ndarray], mixer):
    """Per predictor: the different (context, symbol) pair of each token, the symbol of each pair;
    of all pairs' code bits, the place in the code and the slot, made a block at a time."""
    n = len(bounds) - 1
    for i, context in enumerate(contexts):
        pair, kinds = pd.factorize(context.astype(np.int64) * n + symbol)
        of, context = kinds % n, (kinds // n).astype(np.uint32)
        places, slots = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for a in range(0, len(of), BLOCK):
            owner, place = gather(bounds, of[a:a + BLOCK])
            places.append(place.astype(np.int32))
            slots.append(mixer.slots(np.take(context[a:a + BLOCK], owner), np.take(nodes, place), i))
        yield pair, of, np.concatenate(places), np.concatenate(slots)


def shared(bounds: np.ndarray, nodes: np.ndarray, bits: np.ndarray, symbol: np.ndarray, contexts: list[np.ndarray], mixer: BitMixer):
    """(slots, bits of each token's code) of all code bits.  Equal (context, symbol) pairs share their slots."""
    sizes, out = bounds[symbol + 1] - bounds[symbol], []
    for pair, of, place, slots in pairs(bounds, nodes, symbol, contexts, mixer):
        each = bounds[of + 1] - bounds[of]
        out.append(Shared(slots, Spread(sizes, (np.cumsum(each) - each)[pair]), np.take(bits.astype(np.int8), place),
                          np.repeat(np.bincount(pair, minlength=len(of)).astype(np.uint32), each)))
    return out, sizes


def each_bit(slots: list[Shared]) -> list[np.ndarray]:
    return [s.slots[s.at[:]] for s in slots]


def different(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row among the different ones, a place of each of those)."""
    at = np.zeros(len(keys[0]), np.int64)
    for key in keys:      # below 2^32
        at = pd.factorize((at << 32) + key.astype(np.int64))[0]
    place = np.zeros(int(at.max()) + 1 if len(at) else 0, np.int64)
    place[at] = np.arange(len(at))
    return at, place


def log10_of_codes(bounds: np.ndarray, nodes: np.ndarray, bits: np.ndarray, depths: np.ndarray, symbol: np.ndarray,
                   contexts: list[np.ndarray | None], mixer: BitMixer) -> np.ndarray:
    """log10 probability of each symbol in its contexts (None: 0 everywhere), a block at a time."""
    out = np.ones(len(symbol))
    alone = [mixer.slots(np.zeros(len(nodes), np.uint32), nodes, i) if c is None else None for i, c in enumerate(contexts)]
    for a in range(0, len(symbol), BLOCK):
        begin, of = bounds[symbol[a:a + BLOCK]], out[a:a + BLOCK]
        token, nth = by_depth(bounds[symbol[a:a + BLOCK] + 1] - begin)
        place = begin[token] + nth
        node = np.take(nodes, place)
        slots = [np.take(alone[i], place) if c is None else mixer.slots(np.take(c[a:a + BLOCK], token), node, i) for i, c in enumerate(contexts)]
        p = mixer.probability_by_gate(slots, np.take(depths, place))
        p = np.where(np.take(bits, place) == 1, p, 1.0 - p)
        ends = np.cumsum(np.bincount(nth))
        for x, y in zip([0, *ends], ends):        # a token once
            of[token[x:y]] *= p[x:y]
    return np.log(out) / math.log(10.0)


def first_of(text: np.ndarray) -> np.ndarray:
    """The first place of the same number, of ascending numbers."""
    return np.maximum.accumulate(np.where(np.diff(text, prepend=-1) != 0, np.arange(len(text)), 0))


class HeadBits:
    """Symbols of texts and the contexts, gates and bits of their codes."""

    CONTEXTS, GATES = 3, GATE_DEPTH

    def __init__(self, code: Code):
        self.code = code
        self.lookup = pa.array(code.words, pa.string())
        self.begins = pa.array(code.begins, pa.binary())
        self.nodes = code.nodes.astype(np.uint32)
        self.depths = np.minimum(np.arange(len(code.nodes)) - np.repeat(code.bounds[:-1], np.diff(code.bounds)), GATE_DEPTH - 1)

    def classes(self, words: pa.Array) -> np.ndarray:
        """Symbol of each word as a rare word."""
        begins = pc.binary_slice(words.cast(pa.binary()), 0, BEGIN)
        at = pc.index_in(begins, self.begins).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.where(at < 0, 0, at + self.code.first_class)

    def symbols(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, text, distinct-word code or -1, tail hash) per token, ends included."""
        known = pc.index_in(w.vocab.cast(pa.string()), self.lookup).fill_null(-2).to_numpy(zero_copy_only=False).astype(np.int64) + 2
        known = np.where(known > 1, known, self.classes(w.vocab.cast(pa.string())))
        sizes = np.diff(w.bounds)
        n = len(sizes)
        bounds = w.bounds + np.arange(n + 1)
        symbol = np.full(int(bounds[-1]), 1, np.int64)
        word = np.full(len(symbol), -1, np.int64)
        inner = np.ones(len(symbol), bool)
        inner[bounds[1:] - 1] = False
        word[inner] = w.codes
        symbol[inner] = known[w.codes] if len(w.codes) else 0
        tail = np.zeros(len(symbol), np.uint64)
        if len(w.codes):
            ends = pc.utf8_slice_codeunits(w.vocab, -2).dictionary_encode()
            tail[inner] = hash_words(ends.dictionary)[ends.indices.to_numpy(zero_copy_only=False)][w.codes]
        return symbol, np.repeat(np.arange(n), sizes + 1), word, tail

    def last_two(self, symbol: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last symbol of its text before each token and the one before that."""
        at = np.arange(len(symbol))
        first = first_of(text)
        head = np.maximum.accumulate(np.where(symbol > 1, at, -1)) if len(at) else at
        before = np.concatenate([[-1], head[:-1]]) if len(at) else at
        start = len(self.code.counts)
        inside = before >= first
        earlier = np.where(inside, before[np.maximum(before, 0)], -1)
        return (np.where(inside, symbol[before], start),
                np.where(earlier >= first, symbol[np.maximum(earlier, 0)], start))

    def contexts(self, symbol: np.ndarray, text: np.ndarray, tail: np.ndarray) -> list[np.ndarray]:
        n = len(symbol)
        first = first_of(text)
        start = np.uint64(len(self.code.counts))
        last = self.last_two(symbol, text)[0].astype(np.uint64)
        ending = np.where(np.arange(n) > first, np.concatenate([[np.uint64(0)], tail[:-1]]) if n else tail, start)
        return [low32(c) for c in (np.zeros(n, np.uint64), mix64(last * GOLDEN + np.uint64(1)), mix64(ending + np.uint64(3)))]

    def hashes(self, symbol: np.ndarray, text: np.ndarray, tail: np.ndarray) -> list[np.ndarray]:
        """Hashes that `slot_bits` counts, of the code bits of each predictor's different pairs of context and symbol."""
        return [h for *_, h in pairs(self.code.bounds, self.nodes, symbol, self.contexts(symbol, text, tail), Hashed)]

    def log10(self, symbol: np.ndarray, text: np.ndarray, tail: np.ndarray, mixer: BitMixer) -> np.ndarray:
        """log10 probability of each token; equal symbols in equal contexts are scored once."""
        contexts = self.contexts(symbol, text, tail)
        at, place = different(symbol, *contexts[1:])
        return log10_of_codes(self.code.bounds, self.nodes, self.code.bits, self.depths, symbol[place],
                              [None, *(c[place] for c in contexts[1:])], mixer)[at]

    def shared_bits(self, symbol: np.ndarray, text: np.ndarray, tail: np.ndarray, mixer: BitMixer):
        """(slots, gate, bit, code lengths of the tokens) of all code bits; see `bit_mixer.Shared` and `Spread`."""
        slots, sizes = shared(self.code.bounds, self.nodes, self.code.bits, symbol, self.contexts(symbol, text, tail), mixer)
        begin = self.code.bounds[symbol]
        return slots, Spread(sizes, begin, self.depths), Spread(sizes, begin, self.code.bits), sizes

    def bits(self, symbol: np.ndarray, text: np.ndarray, tail: np.ndarray, mixer: BitMixer):
        """(slots, gate, bit, token) of each code bit."""
        slots, gate, bit, sizes = self.shared_bits(symbol, text, tail, mixer)
        return each_bit(slots), gate[:], bit[:], np.repeat(np.arange(len(sizes)), sizes)


def low32(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class Spelling:
    """Contexts, gates and bits of words spelled in bytes with a final zero byte.
    Bytes have a Huffman code by their frequency in the head words."""

    CONTEXTS, GATES = 4, GATE_DEPTH

    def __init__(self, code: Code):
        seen = np.ones(256, np.int64)
        for word, c in zip(code.words, code.counts[2:]):
            seen += np.bincount(np.frombuffer(word.encode() + b"\0", np.uint8), minlength=256) * int(c)
        nodes, self.coded, self.bounds = huffman(seen.tolist())
        self.nodes = nodes.astype(np.uint32)
        sizes = np.diff(self.bounds)
        self.depths = np.minimum(np.arange(len(nodes)) - np.repeat(self.bounds[:-1], sizes), GATE_DEPTH - 1)

    def letters(self, words: pa.Array | list[bytes]):
        """(byte, contexts, word, byte of the word, the four bytes before) of all bytes."""
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        word = np.repeat(np.arange(len(words)), sizes)
        raw = np.zeros(len(word), np.uint8)
        _, ends, joined = words.buffers()
        if joined is not None:
            first = int(np.frombuffer(ends, np.int32)[words.offset])
            within = np.ones(len(raw), bool)
            within[np.cumsum(sizes) - 1] = False
            raw[within] = np.frombuffer(joined, np.uint8)[first:first + len(raw) - len(words)]
        data = raw.astype(np.uint64)
        nth = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        contexts, h, behind = [], np.full(len(data), np.uint64(11)), np.zeros(len(data), np.uint64)
        for back in range(1, 5):   # the last one to four bytes
            before = np.zeros(len(data), np.uint64)
            before[back:] = data[:-back] + np.uint64(1)
            before[nth < back] = 0
            h = mix64(h * GOLDEN + before)
            contexts.append(low32(h))
            behind = behind << np.uint64(9) | before
        return raw.astype(np.int64), contexts, word, nth, behind

    def hashes(self, words: pa.Array | list[bytes]) -> list[np.ndarray]:
        """Hashes that `slot_bits` counts, of the code bits of each predictor's different pairs of context and byte."""
        letter, contexts, *_ = self.letters(words)
        return [h for *_, h in pairs(self.bounds, self.nodes, letter, contexts, Hashed)]

    def log10(self, words: pa.Array | list[bytes], mixer: BitMixer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log10 probability, word, byte of the word) of all bytes; equal bytes behind equal ones are scored once."""
        letter, contexts, word, nth, behind = self.letters(words)
        at, place = different(letter, behind >> np.uint64(18), behind & np.uint64((1 << 18) - 1))
        lp = log10_of_codes(self.bounds, self.nodes, self.coded, self.depths, letter[place], [c[place] for c in contexts], mixer)
        return lp[at], word, nth

    def shared_bits(self, words: pa.Array | list[bytes], mixer: BitMixer):
        """(slots, gate, bit, word, byte of the word) of all code bits; see `bit_mixer.Shared` and `Spread`."""
        letter, contexts, word, nth, _ = self.letters(words)
        slots, sizes = shared(self.bounds, self.nodes, self.coded, letter, contexts, mixer)
        begin = self.bounds[letter]
        return slots, Spread(sizes, begin, self.depths), Spread(sizes, begin, self.coded), np.repeat(word, sizes), np.repeat(nth, sizes)

    def bits(self, words: pa.Array | list[bytes], mixer: BitMixer):
        """As `shared_bits`, with the slot, gate and bit of each bit."""
        slots, gate, bit, *rest = self.shared_bits(words, mixer)
        return each_bit(slots), gate[:], bit[:], *rest


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all words of all rows (text, train); c counts training rows' only."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, 8 << 20):
            w = split_words(batch.column(0))
            train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            c = np.bincount(w.codes, train[w.doc_of], len(w.vocab)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([w.vocab.cast(pa.string()), pa.array([END])]),
                                              pa.array(np.append(c, int(train.sum())))], names=["word", "c"])

    return docs.select("text", "train").mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def make_code(counts: DataFrame, head: int = HEAD, classes: int = CLASSES) -> Code:
    """The code over the most frequent training words and beginnings; at most
    `head` + `classes` rows come to the driver."""
    whole = counts.where("c > 0").agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
        F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).first()
    ends = counts.where(F.col("word") == END).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    words = counts.where((F.col("c") > 0) & (F.col("word") != END))
    top = words.orderBy(F.desc("c"), "word").limit(head).collect()
    few = counts.sparkSession.createDataFrame([(r["word"],) for r in top], "word string")   # at most `head`
    begin = F.substring(F.col("word").cast("binary"), 1, BEGIN).alias("begin")
    begins = (words.join(F.broadcast(few), "word", "left_anti").groupBy(begin)
              .agg(F.sum("c").alias("c"), F.count("*").alias("v")).orderBy(F.desc("c"), "begin").limit(classes).collect())
    inside, inside_v = (sum(r[x] for r in begins) for x in ("c", "v"))
    rest = whole["n"] - ends - sum(r["c"] for r in top) - inside
    rest_v = whole["v"] - (ends > 0) - len(top) - inside_v
    counted = [rest, ends, *(r["c"] for r in top), *(r["c"] for r in begins)]
    types = [rest_v, int(ends > 0), *([1] * len(top)), *(r["v"] for r in begins)]
    discount = min(0.95, max(0.3, whole["n1"] / max(1, whole["n1"] + 2 * whole["n2"])))
    return Code([r["word"] for r in top], [bytes(r["begin"]) for r in begins], np.array(counted, np.int64),
                np.array(types, np.int64), *huffman(counted), whole["n"], whole["v"], discount)


def merged(spark, rows: DataFrame, mixer: BitMixer) -> BitMixer:
    """Sums the states that tasks have emitted as (page, data).  Tasks turn the sums
    into what scoring needs, two bytes a slot, and only that comes to the driver."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for page, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[page] = BitMixer.add(page, raw, sums.get(page))
        for page, s in sums.items():
            data = s.astype("<f8") if page < 0 else BitMixer.stretch(s).astype("<f2")
            yield pa.RecordBatch.from_pydict({"page": [page], "data": [squeeze(data)]})

    out = rows.repartition("page").mapInArrow(merge, "page long, data binary").collect()
    return mixer.load_stretched((r["page"], unsqueeze(r["data"], "<f8" if r["page"] < 0 else "<f2")) for r in out)


class Hashed:
    """In place of a mixer: whole 32-bit hashes for slots, those that `slot_bits` counts."""

    @staticmethod
    def slots(context: np.ndarray, node: np.ndarray, predictor: int) -> np.ndarray:
        h = BitMixer.hashes(context, node)
        return h[(h & np.uint32(SAMPLE - 1)) == 0].astype(np.int64)


def slot_bits(rows: DataFrame, slots, contexts: int) -> tuple[int, ...]:
    """Bits of the slots of each predictor: as many slots as it has different
    (context, node) pairs in all rows, counted on one hash in `SAMPLE`.
    `slots(batches)` yields the predictors' hashes of a slice."""
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes in slots(batches):
            for i, h in enumerate(hashes):
                some = np.unique(h[(h & (SAMPLE - 1)) == 0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), i)), pa.array(some)], names=["i", "h"])

    found = rows.mapInArrow(sample, "i long, h long").groupBy("i").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()
    pairs = {r["i"]: r["n"] * SAMPLE for r in found}      # one row a predictor
    return tuple(min(32, max(SLOT_BITS, math.ceil(math.log2(pairs.get(i, 1))))) for i in range(contexts))


def train_head(docs: DataFrame, code: Code) -> BitMixer:
    """Learns the head's mixer online in every task, over all training rows."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        head = HeadBits(code)
        for batch in slices(batches, 0, SLICE):
            symbol, text, _, tail = head.symbols(split_words(batch.column(0)))
            yield head.hashes(symbol, text, tail)

    texts = docs.where("train").select("text")
    sizes = slot_bits(texts, hashes, HeadBits.CONTEXTS)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        head, mixer = HeadBits(code), BitMixer(HeadBits.CONTEXTS, HeadBits.GATES, sizes)
        for batch in slices(batches, 0, SLICE):
            symbol, text, _, tail = head.symbols(split_words(batch.column(0)))
            slots, gate, bit, _ = head.shared_bits(symbol, text, tail, mixer)
            mixer.learn(slots, gate, bit)
        if mixer.seen:
            pages, data = zip(*mixer.rows())
            yield pa.RecordBatch.from_pydict({"page": list(pages), "data": list(data)})

    rows = texts.mapInArrow(learn, "page long, data binary")
    return merged(docs.sparkSession, rows, BitMixer(HeadBits.CONTEXTS, HeadBits.GATES, sizes))


def runs(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[list[pa.Array]]:
    """Words of some batches that follow each other, about `most` bytes together."""
    held, size = [], 0
    for batch in slices(batches, column, most):
        words = batch.column(column).cast(pa.binary())
        held.append(words)
        size += pc.sum(pc.binary_length(words)).as_py()
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def train_spelling(rare: DataFrame, code: Code) -> BitMixer:
    """Learns spelling from the distinct rare training words."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        spelling = Spelling(code)
        for some in runs(batches, 0, SLICE // 16):
            yield spelling.hashes(pa.concat_arrays(some))

    words = rare.where("c > 0").select("word")
    sizes = slot_bits(words, hashes, Spelling.CONTEXTS)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        spelling, mixer = Spelling(code), BitMixer(Spelling.CONTEXTS, Spelling.GATES, sizes)
        for some in runs(batches, 0, SLICE // 16):      # counts follow each batch
            slots, gate, bit, word, _ = spelling.bits(pa.concat_arrays(some), mixer)
            ends = np.searchsorted(word, np.cumsum([0, *map(len, some)])).tolist()
            for a, b in zip(ends, ends[1:]):
                mixer.learn([s[a:b] for s in slots], gate[a:b], bit[a:b])
        if mixer.seen:
            pages, data = zip(*mixer.rows())
            yield pa.RecordBatch.from_pydict({"page": list(pages), "data": list(data)})

    return merged(rare.sparkSession, words.mapInArrow(learn, "page long, data binary"),
                  BitMixer(Spelling.CONTEXTS, Spelling.GATES, sizes))


def log10_of_bits(p: np.ndarray, bit: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, np.log(np.where(bit == 1, p, 1.0 - p)), n) / math.log(10.0)


def spelled(words: pa.Array, c: np.ndarray, code: Code, mixer: BitMixer, head: HeadBits, spelling: Spelling) -> tuple[np.ndarray, np.ndarray]:
    """(own, base): log10 probability of rare words with training counts `c` behind their
    class, and by the add-one unigram."""
    n, kind = len(words), head.classes(words.cast(pa.string()))
    lp, word, nth = spelling.log10(words.cast(pa.binary()), mixer)
    given = (kind[word] > 0) & (nth < BEGIN)       # the class tells these bytes
    letters = np.bincount(word, np.where(given, 0.0, lp), n)
    tokens, free = np.maximum(code.counts[kind], 1), code.discount * np.maximum(code.types[kind], 1)
    unseen = np.log10(np.minimum(free / tokens, 1.0)) + letters
    seen = np.log10((np.maximum(c - code.discount, 1e-9) + free * 10.0 ** letters) / tokens)
    return np.where(c > 0, seen, unseen), np.log10((c + 1.0) / (code.total + code.distinct + 1.0))


def rare_words(rare: DataFrame, code: Code, mixer: BitMixer) -> DataFrame:
    """(word, known, own, base) of each rare word, see `spelled`."""
    sent = rare.sparkSession.sparkContext.broadcast((code, mixer))     # grows with the contexts

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, mixer = sent.value
        head, spelling = HeadBits(code), Spelling(code)
        for batch in slices(batches, 0, SLICE // 4):
            c = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            own, base = spelled(batch.column(0), c, code, mixer, head, spelling)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((c > 0).astype(np.int64)), pa.array(own), pa.array(base)],
                                             names=["word", "known", "own", "base"])

    return rare.select("word", "c").mapInArrow(spell, "word string, known long, own double, base double")


DOCS, SYMBOLS, WORDS = 0, 1, 2      # kinds of rows that are dealt
DEALT = "part int, row long, kind int, data binary"
SCORED = ("doc_id long, row long, held_out boolean, n_bytes long, n_tokens long, n_known long, base double, own double, "
          "kind int, data binary")


def packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def dealt(part: np.ndarray, key: np.ndarray, of: np.ndarray, lp: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(part, data) of the tokens: key, row in the slice and training mark, log10 probability."""
    order = np.argsort(key, kind="stable")
    order = order[np.argsort(part[order], kind="stable")]
    part, key, of, lp = part[order], key[order], of[order].astype("<u4"), lp[order].astype("<f4")
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    for a, b in zip(edges, edges[1:]):
        yield int(part[a]), columns(np.diff(key[a:b], prepend=0).astype("<i8"), of[a:b], lp[a:b])


def behind_pairs(held: list[tuple[int, bytes]], symbols: int) -> Iterator[tuple[int, bytes]]:
    """(first row, data) of each slice: its texts, and by how much the counts behind
    the last two symbols change their log10 probability.  `held` has all tokens
    of its pairs, and is emptied.  Pairs are counted a bin of them at a time."""
    rows, keys, ofs, lps, bins = [row for row, _ in held], [], [], [], []
    for i, (_, data) in enumerate(held):
        key, of, lp = uncolumns(data, "<i8", "<u4", "<f4")
        held[i] = None
        keys.append(np.cumsum(key))
        ofs.append(of)
        lps.append(lp)
        bins.append((mix64((keys[-1] // symbols).astype(np.uint64)) % np.uint64(BINS)).astype(np.uint8))
    held.clear()
    sizes = [len(k) for k in keys]
    bins = np.concatenate(bins)
    order, ends = np.argsort(bins, kind="stable").astype(np.uint32), np.cumsum(np.bincount(bins, minlength=BINS))
    del bins
    keys, ofs, lps = (joined(x) for x in (keys, ofs, lps))
    change = np.empty(len(keys))
    for a, b in zip([0, *ends], ends):
        if a < b:
            which = order[a:b]
            change[which] = changed(keys[which], ofs[which] & 1, lps[which].astype(float), symbols)
    del keys, lps, order
    at = 0
    for row, size in zip(rows, sizes):
        part = slice(at, at := at + size)
        texts, which = np.unique(ofs[part] >> 1, return_inverse=True)
        yield row, columns(texts.astype("<u4"), np.bincount(which, change[part], len(texts)).astype("<f4"))


def joined(pieces: list[np.ndarray]) -> np.ndarray:
    """The pieces one after another; the list is emptied."""
    out = np.concatenate(pieces)
    pieces.clear()
    return out


def changed(key: np.ndarray, train: np.ndarray, old: np.ndarray, symbols: int) -> np.ndarray:
    """By how much the counts of (pair, symbol) keys change the log10 probabilities `old`."""
    key, k = np.unique(key, return_inverse=True)
    c = np.bincount(k, train, len(key))
    first = np.flatnonzero(np.diff(key // symbols, prepend=-1))
    sizes = np.diff(first, append=len(key))
    total = np.repeat(np.add.reduceat(c, first), sizes)
    free = np.where(total > 0, PAIR_D * np.repeat(np.add.reduceat((c > 0).astype(float), first), sizes) / np.maximum(total, 1.0), 1.0)
    direct = np.maximum(c - PAIR_D, 0.0) / np.maximum(total, 1.0)
    return np.log10(direct[k] + free[k] * 10.0 ** old) - old


def dealt_words(part: np.ndarray, words: pa.Array, of: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(part, data) of rare words: row in the slice and training mark, times in the text, word."""
    order = np.argsort(part, kind="stable")
    part, of, n = part[order], of[order].astype("<u4"), n[order].astype("<u4")
    words = words.take(pa.array(order))
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype("<u4")
    ends, raw = np.cumsum(sizes, dtype=np.int64), words.to_numpy(zero_copy_only=False)
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    for a, b in zip(edges, edges[1:]):
        letters = np.frombuffer(b"".join(raw[a:b]), np.uint8)
        yield int(part[a]), columns(np.array([b - a], "<u4"), of[a:b], n[a:b], sizes[a:b], letters)


def undealt_words(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, row and mark, times) of `dealt_words`."""
    raw = unsqueeze(data, "u1")
    n = int(raw[:4].view("<u4")[0])
    of, times, sizes = (np.ascontiguousarray(raw[4 + 4 * n * i:4 + 4 * n * (i + 1)].reshape(4, n).T).view("<u4").ravel() for i in range(3))
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(raw[4 + 12 * n:].tobytes())])
    return words, of, times


def behind_classes(held: list[tuple[int, bytes]], code: Code, mixer: BitMixer) -> Iterator[tuple[int, bytes]]:
    """(first row, data) of each slice: its texts, and of their rare words the sums of log10
    probabilities, of those by the add-one unigram, and how many are known.  `held` has
    all tokens of its words."""
    pieces = [undealt_words(data) for _, data in held]
    coded = pa.concat_arrays([p[0] for p in pieces]).dictionary_encode()
    word, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    of, n = (np.concatenate([p[i] for p in pieces]) for i in (1, 2))
    c = np.bincount(word, n * (of & 1), len(words))
    head, spelling, own, base, at = HeadBits(code), Spelling(code), np.zeros(len(words)), np.zeros(len(words)), 0
    for batch in slices([pa.RecordBatch.from_arrays([words], names=["word"])], 0, SLICE // 4):
        part = slice(at, at := at + batch.num_rows)
        own[part], base[part] = spelled(batch.column(0), c[part], code, mixer, head, spelling)
    at = 0
    for (row, _), (_, of, n) in zip(held, pieces):
        k = word[at:(at := at + len(of))]
        texts, which = np.unique(of >> 1, return_inverse=True)
        own_sum, base_sum, known = (np.bincount(which, n * x, len(texts)) for x in (own[k], base[k], c[k] > 0))
        yield row, columns(texts.astype("<u4"), own_sum.astype("<f8"), base_sum.astype("<f8"), known.astype("<u4"))


def head_scores(docs: DataFrame, code: Code, mixer: BitMixer, spelling: BitMixer | None = None) -> DataFrame:
    """Per row: sums over its head symbols.  Further rows have `data`, see `behind_pairs` and,
    of rare words, where the mixer that spells them is given, `behind_classes`."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((code, mixer))   # grows with the contexts
    sent_spelling = spark.sparkContext.broadcast((code, spelling))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + code.total // PAIR_TOKENS)
    symbols = len(code.counts) + 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        code, mixer = sent.value
        head = HeadBits(code)
        unigram = np.log10((code.counts + 1.0) / (code.total + code.distinct + 1.0))
        for batch in slices(batches, 3, SLICE):
            n, w = batch.num_rows, split_words(batch.column(3))
            symbol, text, word, tail = head.symbols(w)
            lp = head.log10(symbol, text, tail, mixer)
            frequent = (symbol > 0) & (symbol < code.first_class)
            known = frequent & (code.counts[symbol] > 0)
            base = np.bincount(text, np.where(frequent, unigram[symbol], 0.0), n)
            rare = np.flatnonzero(~frequent)
            pair, times = np.unique(text[rare] * max(1, len(w.vocab)) + word[rare], return_counts=True)
            of, which = pair // max(1, len(w.vocab)), pair % max(1, len(w.vocab))
            row = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            docs = pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)),
                 pc.binary_length(batch.column(3)).cast(pa.int64()), pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                 pa.array(np.bincount(text, known, n).astype(np.int64)), pa.array(base), pa.array(np.bincount(text, lp, n)),
                 pa.array(np.full(n, DOCS, np.int32)), pa.nulls(n, pa.binary())], names=[n for n, _ in kinds])
            last, last2 = head.last_two(symbol, text)
            before = last2 * symbols + last
            train = ~batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            where = (mix64(before.astype(np.uint64) * GOLDEN) % np.uint64(parts)).astype(np.int32)
            marked = 2 * (row - row[0]) + train
            out = [(int(row[0]) % parts, DOCS, packed(docs))]
            out += [(at, SYMBOLS, data) for at, data in dealt(where, before * symbols + symbol, marked[text], lp)]
            if sent_spelling.value[1] is not None and len(which):
                to = (hash_words(w.vocab) % np.uint64(parts)).astype(np.int32)[which]
                out += [(at, WORDS, data) for at, data in dealt_words(to, w.vocab.cast(pa.binary()).take(pa.array(which)), marked[of], times)]
            at, kind, data = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([int(row[0])] * len(at), pa.int64()),
                                              pa.array(kind, pa.int32()), pa.array(data, pa.binary())], names=["part", "row", "kind", "data"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        held: dict[int, list[tuple[int, bytes]]] = {SYMBOLS: [], WORDS: []}
        for batch in batches:
            for row, kind, data in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if kind == DOCS:
                    yield from pa.ipc.open_stream(data)
                else:
                    held[kind].append((row, data))
        for kind, given in held.items():
            if given:
                give_back()
                for row, data in behind_pairs(given, symbols) if kind == SYMBOLS else behind_classes(given, *sent_spelling.value):
                    has = {"row": pa.array([row], pa.int64()), "kind": pa.array([kind], pa.int32()), "data": pa.array([data], pa.binary())}
                    yield pa.RecordBatch.from_arrays([has.get(n, pa.nulls(1, t)) for n, t in kinds], names=[n for n, _ in kinds])
                given.clear()

    kinds = [("doc_id", pa.int64()), ("row", pa.int64()), ("held_out", pa.bool_()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
             ("n_known", pa.int64()), ("base", pa.float64()), ("own", pa.float64()), ("kind", pa.int32()), ("data", pa.binary())]
    rows = docs.select("doc_id", "row", F.expr("not train").alias("held_out"), "text").mapInArrow(score, DEALT)
    return rows.repartitionById(parts, F.col("part")).mapInArrow(count, SCORED)


def changes(scored: DataFrame) -> DataFrame:
    """(row, own, base, known): what the counts behind the last two symbols add to each row, and its
    rare words."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            text, which = np.unique(np.concatenate([p[0] for p in held]), return_inverse=True)
            sums = [np.bincount(which, np.concatenate([p[i] for p in held]), len(text)) for i in (1, 2, 3)]
            return pa.RecordBatch.from_arrays([pa.array(text.astype(np.int64) + now), *map(pa.array, sums[:2]), pa.array(sums[2].astype(np.int64))],
                                              names=["row", "own", "base", "known"])

        now, held = None, []
        for batch in batches:
            for row, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if row != now and held:
                    yield out()
                    held = []
                now = row
                if kind == WORDS:
                    held.append(uncolumns(data, "<u4", "<f8", "<f8", "<u4"))
                else:
                    text, own = uncolumns(data, "<u4", "<f4")
                    held.append([text, own, np.zeros(len(text)), np.zeros(len(text))])
        if held:
            yield out()

    rows = scored.where("data is not null").select("row", "kind", "data")
    return rows.repartition("row").sortWithinPartitions("row").mapInArrow(add, "row long, own double, base double, known long")


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       whole.alias("text"), F.expr(f"not ({HELD_OUT.format(key=f'`{key}`')})").alias("train"))
    counts = stored(word_counts(rows), "counts")
    code = make_code(counts, head)
    few = docs.sparkSession.createDataFrame([(w,) for w in [END, *code.words]], "word string")   # at most head + 1
    rare = counts.join(F.broadcast(few), "word", "left_anti")
    spelling = train_spelling(rare, code)
    mixer = train_head(rows, code)
    both = stored(head_scores(rows, code, mixer, spelling), "head")
    sums = changes(both).select("row", F.col("own").alias("more"), F.col("base").alias("rare_base"), "known")
    score = F.col("own") + F.coalesce("more", F.lit(0.0))
    out = both.where("data is null").join(sums, "row", "left")
    return out.select(F.col("doc_id").alias(key), "held_out", "n_tokens",
                      (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                      F.lit(code.total).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
                      score.alias("score"), (-score / LOG10_2 / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))


@register("op8_context_mixing")
def op8_context_mixing(spark, sf_dir):
    """log10 probability of every text of `documents`."""
    return score_texts(table(spark, sf_dir, "documents"))
