"""Cross-tokenizer alignment (operator 11).

Tokenizers A (byte-level) and B (pieces with byte fallback) both cut the same bytes.
Offsets where both cut part the text into groups; tokens whose bytes overlap are
linked.  A pair of ids (a, b) scores the number of documents that hold it linked.

Inverted pair bitmaps.  Documents are taken in segments (a bounded number of links).
Per segment and pair, plane p is the set of documents whose number of such links has
bit p set, kept as a bitmap over the segment's documents or, where that is shorter, as
a list of 16-bit positions.  The planes of a pair are OR-merged and popcounted: that
many of its documents hold it.  Only (segment, pair, documents) rows are shuffled, to
be added up per pair, and come back to their segment with the pair's score; there
the planes, which never left it, hand the scores out to the documents:
2^p x score for every document of plane p.

Units.  Both tokenizers always cut between a character that is no blank and a space, and
between a letter and a sign that no piece of B holds side by side; so texts are cut
there, and ids, groups and links are found once per distinct unit of a Python worker.

Defined cases: a null text, an empty one, and one whose bytes either tokenizer does not
give back (such as one with U+2581) have no tokens: zeros and ''.  Repeated rows and ids
are documents of their own.  An empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsieve.llm.common import register, slices, stored, table
from crawlsieve.llm.encode import tokenizer_file

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
SEGMENT_LINKS = 3_000_000       # links of a segment; a single document may hold more
SEGMENT_DOCS = 1 << 16          # positions are 16-bit
MEMO_UNITS = 600_000
MEMO_LINKS = 8_000_000
SLICE = 4 << 20
MERGE_BYTES = 16 << 20          # bitmaps merged at a time
ID_BITS = 16                    # ids of either tokenizer are below 2^16
LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ"
PART_DDL = ("segment long, at int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs array<binary>, sizes array<binary>, sets array<binary>")
DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


class Aligner:
    """Ids, groups and links of texts, by one pair of tokenizer files."""

    def __init__(self, file_a: str, file_b: str, memo_units: int = MEMO_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        # bytes of one-byte letters of A: the printable ones stand for themselves
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.bytes_a = {i: bytes(letter[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        if max(len(self.bytes_b), max(self.bytes_a) + 1) > 1 << ID_BITS:
            raise ValueError("ids need more than 16 bits")
        self.length_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        self.length_a[list(self.bytes_a)] = [len(t) for t in self.bytes_a.values()]
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.signs_of = [f"{i}{sign}" for n, signs in ((len(self.length_a), ",|"), (len(self.length_b), ",;"))
                         for i in range(n) for sign in signs]
        side_by_side = {(x, y) for i, p in enumerate(pieces) if self.b.is_byte(i) is False for x, y in zip(p, p[1:])}
        if any(y == SPACE != x for x, y in side_by_side):
            raise ValueError("a piece crosses from a word to a space")
        one_letter = re.compile(f"[{LETTER}]")
        joined = {y for x, y in side_by_side if one_letter.match(x)}
        self.signs = "".join(re.escape(c) for c in map(chr, range(128)) if not c.isalpha() and c not in joined)
        rest = r"(?:[^\S ]\s*\S*)*"
        self.units = re.compile(rf" [{LETTER}]+(?=[{self.signs}]|\Z)| \s*\S*{rest}|[^\S ]\s*\S*{rest}|\S+{rest}")
        self.space = self.b.piece_to_id(SPACE)
        self.most = memo_units
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.numbers = np.zeros((0, 5), np.int64)    # n_a, n_b, n_groups, n_links, bytes given back
        self.groups: list[str] = []
        self.starts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int64)

    def ids_b(self, units: list[str]) -> list[list[int]]:
        """B's ids of units as they stand inside a text.  The library puts a space before
        what it encodes: it takes the place of a leading one, or a letter is put between."""
        lead = [u.startswith(" ") for u in units]
        ids = self.b.encode([u[1:] if s else "a" + u for u, s in zip(units, lead)], num_threads=1)
        return [[self.space] if u == " " else i if s else i[1:] for u, i, s in zip(units, ids, lead)]

    def links(self, texts: list[bytes], a: list[list[int]], b: list[list[int]]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Of texts with their ids: (n_a, n_b, n_groups, n_links, bytes given back) each, the
        texts of their groups, and the linked pairs one text after another."""
        whole = np.fromiter((b"".join(map(self.bytes_a.__getitem__, i)) == t and b"".join(map(self.bytes_b.__getitem__, j)) == t
                             for t, i, j in zip(texts, a, b)), bool, len(texts))
        a, b = ([i if ok else [] for i, ok in zip(ids, whole)] for ids in (a, b))
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in ((a, n_a), (b, n_b)))
        # all texts lie one after another: tokens are spans of one line of bytes
        end_a, end_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        first = np.searchsorted(end_b, end_a - self.length_a[ids_a], side="right")
        last = np.searchsorted(end_b, end_a, side="left")
        n = last - first + 1
        per_text = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(n_a)])]
        pairs = np.repeat(ids_a, n) << ID_BITS | ids_b[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        cut_a, cut_b = end_b[last] == end_a, end_a[np.searchsorted(end_a, end_b)] == end_b
        # ids of A, then of B, of each group, each with the sign that follows it
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        tokens_b = np.bincount(group_b, minlength=int(cut_a.sum()))
        tokens_a = np.bincount(group_a, minlength=int(cut_a.sum()))
        place_a = np.arange(len(ids_a)) + (np.cumsum(tokens_b) - tokens_b)[group_a]
        place_b = np.arange(len(ids_b)) + np.cumsum(tokens_a)[group_b]
        sign = np.empty(len(ids_a) + len(ids_b), np.int64)
        sign[place_a], sign[place_b] = 2 * ids_a + cut_a, 2 * (len(self.length_a) + ids_b) + cut_b
        written = list(map(self.signs_of.__getitem__, sign.tolist()))
        upto = np.cumsum([0, *(n_a + n_b)]).tolist()
        groups = ["".join(written[x:y])[:-1] for x, y in zip(upto, upto[1:])]
        n_groups = np.diff(np.concatenate([[0], np.cumsum(cut_a)])[np.concatenate([[0], np.cumsum(n_a)])])
        return np.stack([n_a, n_b, n_groups, np.diff(per_text), whole], axis=1), groups, pairs

    def _remember(self, units: list[str]) -> None:
        ids_a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        numbers, groups, pairs = self.links([u.encode() for u in units], ids_a, self.ids_b(units))
        self.place.update(zip(units, range(len(self.groups), len(self.groups) + len(units))))
        self.groups += groups
        sizes = numbers[:, 3]
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.pool = np.concatenate([self.pool, pairs])
        self.numbers = np.concatenate([self.numbers, numbers])

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Per text (n_a, n_b, n_groups, n_links) and the hash of its groups; then the
        pair of every link and the text it is in."""
        cut = [self.units.findall(" " + t) if t else [] for t in texts]
        enc = pa.array(chain.from_iterable(cut), pa.string()).dictionary_encode()
        names = enc.dictionary.to_pylist()
        fresh = [u for u in names if u not in self.place]
        if len(self.place) + len(fresh) > self.most:
            self._forget()                  # the memo stays bounded
            fresh = names
        if fresh:
            self._remember(fresh)
        rows = np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))[enc.indices.to_numpy(zero_copy_only=False)]
        text_of = np.repeat(np.arange(len(texts)), [len(u) for u in cut])
        numbers = np.zeros((len(texts), 5), np.int64)
        np.add.at(numbers, text_of, self.numbers[rows])
        whole = (numbers[:, 4] == [len(u) for u in cut]) & np.array([bool(t) for t in texts], bool)
        numbers[~whole] = 0
        digests, at = [], 0
        order = rows.tolist()
        for ok, units in zip(whole, cut):
            joined = ";".join([self.groups[r] for r in order[at:at + len(units)]]) if ok else ""
            digests.append(hashlib.sha256(joined.encode()).hexdigest() if ok else "")
            at += len(units)
        n = np.where(whole[text_of], self.numbers[rows, 3], 0) if len(rows) else np.zeros(0, np.int64)
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        pairs = self.pool[np.repeat(self.starts[rows] - (ends - n), n) + np.arange(total)]
        where = np.repeat(text_of, n)
        if len(self.pool) > MEMO_LINKS:     # long units are not kept for long
            self._forget()
        return numbers[:, :4], digests, pairs, where


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(file_a: str, file_b: str) -> Aligner:
    """The aligner of this Python worker (workers are reused between tasks)."""
    if (file_a, file_b) not in _ALIGNERS:
        _ALIGNERS[file_a, file_b] = Aligner(file_a, file_b)
    return _ALIGNERS[file_a, file_b]


# --- sets of documents -------------------------------------------------------------

def pack_sets(rank: np.ndarray, n_sets: int, where: np.ndarray, n_docs: int) -> tuple[bytes, bytes]:
    """(sizes, sets) of n_sets sets of positions below n_docs; (rank, where) is sorted.  A
    set is a bitmap if that is shorter than two bytes a position."""
    sizes = np.bincount(rank, minlength=n_sets)
    bitmap = -(-n_docs // 8)
    dense = 2 * sizes > bitmap
    lengths = np.where(dense, bitmap, 2 * sizes)
    out = np.zeros(int(lengths.sum()), np.uint8)
    start = np.cumsum(lengths) - lengths
    first = np.cumsum(sizes) - sizes
    in_dense = dense[rank]
    r, w = rank[~in_dense], where[~in_dense]
    place = start[r] + 2 * (np.flatnonzero(~in_dense) - first[r])
    out[place], out[place + 1] = w & 255, w >> 8
    r, w = rank[in_dense], where[in_dense]
    np.bitwise_or.at(out, start[r] + (w >> 3), (1 << (w & 7)).astype(np.uint8))
    return sizes.astype("<i4").tobytes(), out.tobytes()


def unpack_sets(sizes: bytes, sets: bytes, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank, where) of pack_sets, in any order."""
    sizes, data = np.frombuffer(sizes, "<i4").astype(np.int64), np.frombuffer(sets, np.uint8)
    bitmap = -(-n_docs // 8)
    dense = 2 * sizes > bitmap
    lengths = np.where(dense, bitmap, 2 * sizes)
    start = np.cumsum(lengths) - lengths
    n = np.where(dense, 0, sizes)
    rank = np.repeat(np.arange(len(sizes)), n)
    place = np.repeat(start - 2 * (np.cumsum(n) - n), n) + 2 * np.arange(int(n.sum()))
    where = data[place].astype(np.int64) | data[place + 1].astype(np.int64) << 8
    full = np.flatnonzero(dense)
    if not len(full):
        return rank, where
    maps = data[start[full][:, None] + np.arange(bitmap)]
    r, w = np.nonzero(np.unpackbits(maps, axis=1, bitorder="little"))
    return np.concatenate([rank, full[r]]), np.concatenate([where, w])


def documents_per_pair(planes: list[tuple[bytes, bytes, bytes]], n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs, and how many documents hold each: its planes OR-merged and popcounted.
    A pair of one plane has as many documents as that plane."""
    pairs = [np.frombuffer(p, "<i8") for p, _, _ in planes]
    sizes = [np.frombuffer(s, "<i4").astype(np.int64) for _, s, _ in planes]
    all_pairs, times = np.unique(np.concatenate(pairs), return_counts=True)
    n, several = np.zeros(len(all_pairs), np.int64), all_pairs[times > 1]
    held = []
    for p, s, (_, raw_sizes, sets) in zip(pairs, sizes, planes):
        at = np.searchsorted(several, p)
        shared = several[np.minimum(at, len(several) - 1)] == p if len(several) else np.zeros(len(p), bool)
        n[np.searchsorted(all_pairs, p[~shared])] = s[~shared]
        if shared.any():
            rank, where = unpack_sets(raw_sizes, sets, n_docs)
            use = shared[rank]
            held.append(at[rank[use]] << ID_BITS | where[use])
    if held:
        bitmap = -(-n_docs // 8)
        keys, step = np.sort(np.concatenate(held)), max(1, MERGE_BYTES // bitmap)
        for first in range(0, len(several), step):
            some = keys[np.searchsorted(keys, first << ID_BITS):np.searchsorted(keys, first + step << ID_BITS)]
            rank, where = (some >> ID_BITS) - first, some & ((1 << ID_BITS) - 1)
            merged = np.zeros((min(step, len(several) - first), bitmap), np.uint8)
            np.bitwise_or.at(merged, (rank, where >> 3), (1 << (where & 7)).astype(np.uint8))
            n[np.searchsorted(all_pairs, several[first:first + step])] = np.bitwise_count(merged).sum(axis=1, dtype=np.int64)
    return all_pairs, n


# --- jobs --------------------------------------------------------------------------

def _rows(n: int, **columns) -> pa.RecordBatch:
    """Rows of PART_DDL; columns that are not given are null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<binary>": pa.list_(pa.binary())}
    fields = [f.split() for f in PART_DDL.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in fields],
        names=[name for name, _ in fields])


def _segment(number: int, ids: list, docs: list, pairs: np.ndarray, where: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of a segment: one per document, then one with all planes."""
    numbers = np.concatenate([n for n, _ in docs])
    n = len(numbers)
    yield _rows(n, segment=np.full(n, number), at=np.arange(n), doc_id=pa.concat_arrays(ids),
                groups_sha256=list(chain.from_iterable(d for _, d in docs)), **dict(zip(DOC[1:5], numbers.T)))
    key = np.sort(pairs << ID_BITS | where)
    if not len(key):
        return
    first = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.diff(first, append=len(key))
    key = key[first]
    planes = []
    for plane in range(int(times.max()).bit_length()):
        k = key[(times >> plane & 1).astype(bool)]
        own, rank = np.unique(k >> ID_BITS, return_inverse=True)
        planes.append((own.astype("<i8").tobytes(), *pack_sets(rank, len(own), k & ((1 << ID_BITS) - 1), n)))
    pairs, sizes, sets = zip(*planes)
    yield _rows(1, segment=[number], at=[n], pairs=[pairs], sizes=[sizes], sets=[sets])


def _index(file_a: str, file_b: str, segment_links: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, number = aligner(file_a, file_b), TaskContext.get().partitionId() << 32
        ids, docs, pairs, where, n_docs, n_links = [], [], [], [], 0, 0
        for batch in slices(batches, 1, SLICE):
            for at in range(0, batch.num_rows, SEGMENT_DOCS):
                part = batch.slice(at, SEGMENT_DOCS)
                numbers, digests, p, w = align.align(part.column(1).to_pylist())
                if n_docs and (n_links + len(p) > segment_links or n_docs + part.num_rows > SEGMENT_DOCS):
                    yield from _segment(number, ids, docs, np.concatenate(pairs), np.concatenate(where))
                    number += 1
                    ids, docs, pairs, where, n_docs, n_links = [], [], [], [], 0, 0
                ids.append(part.column(0))
                docs.append((numbers, digests))
                pairs.append(p)
                where.append(w + n_docs)
                n_docs, n_links = n_docs + part.num_rows, n_links + len(p)
        if n_docs:
            yield from _segment(number, ids, docs, np.concatenate(pairs), np.concatenate(where))
    return run


COUNT_DDL = "segment long, pair long, n int"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for segment, n_docs, *planes in zip(*(c.to_pylist() for c in batch.columns)):
            pairs, n = documents_per_pair(list(zip(*planes)), n_docs)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), segment)), pa.array(pairs), pa.array(n.astype(np.int32))],
                                             names=["segment", "pair", "n"])


SCORE_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _hand_out(parts: pa.Table, scores: pa.Table) -> pa.Table:
    """Documents of one segment with the sums of their links' scores."""
    docs = parts.filter(pc.is_null(parts["pairs"])).sort_by("at")
    n = docs.num_rows
    pair = scores["pair"].to_numpy()
    order = np.argsort(pair)
    pair, total = pair[order], scores["documents"].to_numpy()[order]
    best = scores["best"].to_numpy()[order].astype(np.int64)
    count_sum, n_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for row in parts.filter(pc.is_valid(parts["pairs"])).select(["pairs", "sizes", "sets"]).to_pylist():
        for plane, (pairs, sizes, sets) in enumerate(zip(row["pairs"], row["sizes"], row["sets"])):
            rank, where = unpack_sets(sizes, sets, n)
            at = np.searchsorted(pair, np.frombuffer(pairs, "<i8"))[rank]
            np.add.at(count_sum, where, total[at] << plane)
            np.add.at(n_best, where, best[at] << plane)
    columns = {c: docs[c] for c in DOC} | {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
    return pa.table({c: columns[c] for c in (f.split()[0] for f in SCORE_DDL.split(", "))})


def pair_counts(parts: DataFrame) -> DataFrame:
    """(segment, pair, n): documents of each segment that hold the pair linked."""
    planes = parts.where("pairs is not null").select("segment", "at", "pairs", "sizes", "sets")
    return planes.mapInArrow(_count, COUNT_DDL)


def pair_index(docs: DataFrame, file_a: str, file_b: str, key: str = "doc_id", text: str = "text",
               segment_links: int = SEGMENT_LINKS) -> DataFrame:
    """The inverted index: a row per document, and one per segment with the planes of its pairs."""
    read = docs.select(F.col(key).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit("")))
    return stored(read.mapInArrow(_index(file_a, file_b, segment_links), PART_DDL), "index")


def pair_scores(counts: DataFrame) -> DataFrame:
    """(pair, documents, best): documents of all segments; whether no other pair of its A id has more."""
    total = counts.groupBy("pair").agg(F.sum(F.col("n").cast("long")).alias("documents"))
    total = stored(total, "pairs")
    a = F.shiftright("pair", ID_BITS)
    most = total.groupBy(a.alias("a")).agg(F.max("documents").alias("most"))
    # at most one row per id of tokenizer A
    return (total.withColumn("a", a).join(F.broadcast(most), "a")
            .select("pair", "documents", (F.col("documents") == F.col("most")).alias("best")))


def align(docs: DataFrame, file_a: str, file_b: str, key: str = "doc_id", text: str = "text",
          segment_links: int = SEGMENT_LINKS) -> DataFrame:
    """One row per document: token, group and link counts, and the scores of its links."""
    parts = pair_index(docs, file_a, file_b, key, text, segment_links)
    counts = stored(pair_counts(parts), "counts")
    scored = counts.select("segment", "pair").join(pair_scores(counts), "pair").select("segment", "pair", "documents", "best")
    return (parts.groupBy("segment").cogroup(scored.groupBy("segment")).applyInArrow(_hand_out, SCORE_DDL)
            .withColumnRenamed("doc_id", key))


@register("op11_pair_bitmaps")
def op11_pair_bitmaps(spark, sf_dir):
    """Links between the tokens of two tokenizers in all `documents`, and their scores."""
    return align(table(spark, sf_dir, "documents"), tokenizer_file(FILE_A), tokenizer_file(FILE_B))
