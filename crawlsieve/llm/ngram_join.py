"""N-gram Jaccard join by grouped prefixes (operator 5).

A document's set holds its distinct k-word shingles (64-bit hashes).  Two
documents link when `100 * |intersection| >= percent * |union|`; the result is
the component of links each document belongs to.

1. Shingles are ordered rare first by a count sketch over all documents (2^20
   counters, merged from per-task counters).  Any fixed order is correct; a
   good one keeps frequent passages out of the prefixes.
2. Documents with equal sets become one node.  The first
   `n - ceil(t * n) + 1` shingles of a set are its prefix; linked sets share a
   prefix shingle.  Nodes with identical prefix and size form one *group*, and
   only groups are posted under the prefix shingles.
3. Group pairs pass the size and position filters and are expanded to members.  A
   pair of members passes the bitmap filter (1,024-bit signatures differ in no more
   bits than the sets in shingles) and is verified on the whole sets.
4. Only components are asked for, so pairs that are connected already need no
   look.  First every group of a list meets the list's hub (its first group by
   hash), which covers lists of two whole.  Longer lists get `ROUNDS` more hubs, each outside
   their largest component; then pairs are drawn only between *different*
   components, what lies outside the largest one against the list; in lists of many
   components the bitmap filter is part of that join.  A group of thousands of near copies
   thus costs rows in proportion to its size, and no link between different
   components is lost.  Sets too small to link with any other set are not posted.

Written tables in the shared folder cut the lineage between steps.  Nothing but
counts and the sketch (4 MB) reaches the driver.

Defined cases: a null text is empty; a document without words has an empty set,
links with nothing and is its own component; fewer than k words are one
shingle; repeated rows and ids are separate documents; a component without any
id is null; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsieve.llm.common import register, slices, squeeze, stored, table, unsqueeze
from crawlsieve.llm.components import components
from crawlsieve.llm.words import distinct_shingles, mix64, split_words

SKETCH_BITS = 20
PAGE = 4096
ROUNDS = 1
SALT = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))   # two streams of a 128-bit set id
SLICE = 2 << 20
SIGNATURE = 16            # 64-bit words of a set's bitmap
FEW = 8                   # components of a list that meet without their bitmaps
BROADCAST_BYTES = 8 << 20
ASKED_BYTES = 64          # of a row (id, set id, document id) that is broadcast


def _buckets(h: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(h) >> np.uint64(64 - bits)).astype(np.int64)


def count_sketch(texts: DataFrame, k: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """How many (document, shingle) pairs fall in each of 2^bits buckets, over
    all rows of the one-column table `texts`."""
    page = min(PAGE, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for batch in slices(batches, 0, SLICE):
            h, _ = distinct_shingles(split_words(batch.column(0)), k)
            counts += np.bincount(_buckets(h, bits), minlength=1 << bits)
        for p in np.flatnonzero(counts.reshape(-1, page).any(axis=1)).tolist():
            part = np.minimum(counts[p * page:(p + 1) * page], 0xFFFFFFFF).astype("<u4")
            yield pa.RecordBatch.from_pydict({"page": [p], "counts": [squeeze(part)]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pages[p] = pages.get(p, 0) + unsqueeze(raw, "<u4").astype(np.int64)
        for p, c in pages.items():
            yield pa.RecordBatch.from_pydict({"page": [p], "counts": [c.astype("<i8").tobytes()]})

    ddl = "page long, counts binary"
    out = np.zeros(1 << bits, np.int64)
    # 2^bits counters in all
    for row in texts.mapInArrow(count, ddl).repartition("page").mapInArrow(merge, ddl).collect():
        out[row["page"] * page:(row["page"] + 1) * page] = np.frombuffer(row["counts"], "<i8")
    return out


def _set_ids(h: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """128-bit ids of sets lying one after another (none empty)."""
    with np.errstate(over="ignore"):
        parts = [np.add.reduceat(mix64(h ^ s), starts) for s in SALT]
    return [a.tobytes() + b.tobytes() for a, b in zip(*parts)]


def _signatures(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Parities of the shingles in each of SIGNATURE * 64 cells, as n x SIGNATURE numbers.
    Every shingle that one of two sets has alone turns one bit."""
    cell = doc * (SIGNATURE * 64) + (mix64(h ^ SALT[0]) % np.uint64(SIGNATURE * 64)).astype(np.int64)
    odd = (np.bincount(cell, minlength=n * SIGNATURE * 64) & 1).astype(bool).reshape(n, SIGNATURE * 64)
    return np.packbits(odd, axis=1).view("<i8")


def prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def nodes(docs: DataFrame, k: int, percent: int, counts: np.ndarray) -> DataFrame:
    """doc_id, row, n, set_id, prefix_id, prefix, signature per row of (doc_id, text, row)."""
    sent = docs.sparkSession.sparkContext.broadcast(counts)   # 2^bits counters
    bits = int(len(counts)).bit_length() - 1
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("set_id", pa.binary()),
                        ("prefix_id", pa.binary()), ("prefix", pa.list_(pa.int64())),
                        ("signature", pa.list_(pa.int64()))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        for batch in slices(batches, 1, SLICE):
            h, doc = distinct_shingles(split_words(batch.column(1)), k)
            n = np.bincount(doc, minlength=batch.num_rows)
            full = np.flatnonzero(n)
            starts = np.concatenate([[0], np.cumsum(n[full])])[:-1]
            order = np.lexsort((h, frequent[_buckets(h, bits)], doc))
            ranked = h[order]
            size = n[full]
            take = prefix_length(size, percent)
            ends = np.cumsum(take)
            inside = np.repeat(starts - (ends - take), take) + np.arange(int(ends[-1]) if len(ends) else 0)
            prefix = ranked[inside]
            sets, groups = [None] * batch.num_rows, [None] * batch.num_rows
            if len(full):
                first = ends - take
                place = np.arange(len(prefix)) - np.repeat(first, take)
                keyed = mix64(prefix + (place + 1).astype(np.uint64) * np.repeat(mix64(size.astype(np.uint64)), take))
                for i, s, g in zip(full, _set_ids(h, starts), _set_ids(keyed, first)):
                    sets[i], groups[i] = s, g
            bounds = np.zeros(batch.num_rows + 1, np.int32)
            lengths = np.zeros(batch.num_rows, np.int64)
            lengths[full] = take
            np.cumsum(lengths, out=bounds[1:])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n.astype(np.int64)),
                 pa.array(sets, pa.binary()), pa.array(groups, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(prefix.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * SIGNATURE),
                                          pa.array(_signatures(h, doc, batch.num_rows).ravel()))], schema=schema)

    return docs.mapInArrow(make, "doc_id long, row long, n long, set_id binary, prefix_id binary, prefix array<long>, "
                                 "signature array<long>")


def shingle_sets(texts: DataFrame, k: int) -> DataFrame:
    """(id, shingles) of rows (text, id, set_id) whose text has that set."""
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, SLICE):
            h, doc = distinct_shingles(split_words(batch.column(0)), k)
            if not len(h):
                continue
            starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            bounds = np.concatenate([starts, [len(h)]]).astype(np.int32)
            asked = batch.take(pa.array(doc[starts]))
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(h.view(np.int64)))
            own = pa.array([a == b for a, b in zip(_set_ids(h, starts), asked.column(2).to_pylist())])
            yield pa.RecordBatch.from_arrays([asked.column(1).filter(own), lists.filter(own)], schema=schema)

    return texts.mapInArrow(make, "id long, shingles array<long>")


class _Join:
    """The steps over one input; `percent` is the least similarity.  A node (distinct
    set) is named by the least number of its rows, a group by that of its nodes."""

    def __init__(self, docs: DataFrame, k: int, percent: int, bits: int):
        self.docs, self.k, self.percent = docs, k, percent
        counts = count_sketch(docs.select("text"), k, bits)
        self.rows = stored(nodes(docs, k, percent, counts), "rows")
        found = self.rows.where("n > 0")
        sets = found.groupBy("set_id").agg(
            F.min("row").alias("id"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
            F.first("prefix_id").alias("prefix_id"), F.first("signature").alias("signature"))
        sets = stored(sets, "sets")
        groups = sets.groupBy("prefix_id").agg(F.min("id").alias("group"), F.count("*").alias("size"))
        self.nodes = stored(sets.join(groups, "prefix_id").select("id", "set_id", "doc_id", "n", "signature", "group", "size"),
                            "nodes")
        # a group's number is that of one of its rows, which has the group's prefix
        first = self.nodes.where("id = group").select("id", "size")
        posted = (found.select(F.col("row").alias("group"), "n", "prefix").join(first, F.col("group") == F.col("id"))
                  .select("group", "n", "size", F.posexplode("prefix").alias("pos", "token")))
        # a set with one shingle more or less than n must be able to link
        posted = posted.where(f"100 * n >= {percent} * (n + 1) or 100 * (n - 1) >= {percent} * n")
        # per token: how many nodes, and its hub.  Postings are dealt by token once, for this and for the
        # join with it; both stream, so a frequent token is long work for one task but never held there
        posted = posted.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "token")
        lists = (posted.groupBy("token").agg(
            F.sum("size").alias("all"), F.max("size").alias("most"), F.min(F.struct(F.xxhash64("group").alias("h"), "group", "n", "pos")).alias("hub"))
            .where("all > 1").select("token", F.struct("hub.group", "hub.n", "hub.pos").alias("hub"),
                                     ((F.col("all") > 2) | (F.col("most") > 1)).alias("open")))
        self.postings = stored(posted.join(lists, "token").select("token", "group", "n", "pos", "size", "hub", "open"), "postings")
        self.links = None
        self.labels = self.nodes.select("id", F.col("id").alias("component"))

    def _fits(self, a: str, b: str):
        """Size and position filters of two posted groups."""
        p, q = self.percent, 100 + self.percent
        return F.expr(f"100 * least({a}n, {b}n) >= {p} * greatest({a}n, {b}n) and "
                      f"{q} * (1 + least({a}n - {a}pos - 1, {b}n - {b}pos - 1)) >= {p} * ({a}n + {b}n)")

    def _close(self, s: str, t: str, n_s: str, n_t: str):
        """Bitmap filter: q * |a and b| >= p * (x + y), and 2 * |a and b| = x + y - |a xor b|."""
        p, q = self.percent, 100 + self.percent
        differ = " + ".join(f"bit_count({s}[{i}] ^ {t}[{i}])" for i in range(SIGNATURE))
        return F.expr(f"{q} * ({n_s} + {n_t} - ({differ})) >= {2 * p} * ({n_s} + {n_t})")

    def _verify(self, pairs: DataFrame) -> DataFrame:
        """(u, v) of the pairs of nodes that link."""
        p, q = self.percent, 100 + self.percent
        one, other = (self.nodes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("signature").alias(s),
                                        F.struct("id", "set_id", F.col("doc_id").alias("of")).alias(f"at_{x}"))
                      for x, s in (("u", "s"), ("v", "t")))
        total = F.col("n_u") + F.col("n_v")
        close = stored(pairs.join(one, "u").join(other, "v").where(self._close("s", "t", "n_u", "n_v"))
                       .select("u", "v", total.alias("total"), "at_u", "at_v"), "close")
        asked = stored(close.select("at_u.*").unionByName(close.select("at_v.*")).distinct(), "asked")
        if asked.count() * ASKED_BYTES <= BROADCAST_BYTES:
            asked = F.broadcast(asked)
        # a repeated id may bring other texts along; the set id tells them
        texts = self.docs.select("doc_id", "text").join(asked, F.col("doc_id").eqNullSafe(F.col("of"))).select("text", "id", "set_id")
        sets = stored(shingle_sets(texts, self.k), "shingles")
        both = (close.select("u", "v", "total").join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u")
                .join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v"))
        return both.where(q * F.size(F.array_intersect("a", "b")) >= p * F.col("total")).select("u", "v")

    def _add(self, links: DataFrame) -> None:
        """Adds links and relabels."""
        new = stored(links, "links")
        if new.isEmpty():
            return
        self.links = new if self.links is None else stored(self.links.unionByName(new), "links")
        self.labels = stored(self.nodes.select("id").join(components(self.links), "id", "left")
                             .select("id", F.coalesce("component", "id").alias("component")), "labels")

    def star(self) -> None:
        """All groups of a list against its hub, and all members of a group
        against its first one."""
        met = self.postings.where("group <> hub.group").where(self._fits("", "hub.")).select("group", F.col("hub.group").alias("u"))
        own = self.nodes.where("size > 1 and id <> group").select(F.col("group").alias("u"), F.col("id").alias("v"))
        members = self.nodes.select("group", F.col("id").alias("v"))
        pairs = met.distinct().join(members, "group").select("u", "v").unionByName(own)
        self._add(self._verify(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()))

    def _entities(self) -> tuple[DataFrame, DataFrame]:
        """Members (id, group, component); postings of long lists per (group,
        component), with whether it is the list's largest component and how many
        components the list holds, for lists that still hold more than one."""
        members = stored(self.nodes.select("id", "group").join(self.labels, "id").select("id", "group", "component"), "members")
        of = members.groupBy("group", "component").agg(F.min("id").alias("first"))
        entities = self.postings.where("open").select("token", "group", "n", "pos").join(of, "group")
        sizes = entities.groupBy("token", "component").agg(F.count("*").alias("k"))
        lists = (sizes.groupBy("token").agg(F.max(F.struct("k", "component")).alias("top"), F.count("*").alias("parts"))
                 .where("parts > 1").select("token", F.col("top.component").alias("top"), "parts"))
        return members, stored(entities.join(lists, "token").withColumn("main", F.col("component") == F.col("top")).drop("top"),
                               "entities")

    def peel(self) -> None:
        """As `star`, with hubs outside each list's largest component: what the first
        hubs have joined is left aside, and the next cluster joins around its own."""
        members, entities = self._entities()
        outside = entities.where("not main")
        hubs = (outside.groupBy("token").agg(F.min(F.struct(F.xxhash64("first").alias("h"), "first", "component", "n", "pos")).alias("hub"))
                .select("token", "hub.*"))
        met = (outside.alias("e").join(hubs.alias("h"), "token").where("e.component <> h.component")
               .where(self._fits("e.", "h.")).select("group", "e.component", F.col("h.first").alias("u")).distinct())
        pairs = members.join(met, ["group", "component"]).select(F.least("u", "id").alias("u"), F.greatest("u", "id").alias("v"))
        self._add(self._verify(pairs.distinct()))

    def rest(self) -> None:
        """All remaining pairs between different components of a long list: what lies
        outside the largest component against all of the list.  A list of few components
        gives pairs of groups; in one of many, members meet with their bitmaps."""
        members, entities = self._entities()
        many = entities.where(F.col("parts") > FEW)
        known = self.nodes.select("id", "signature")
        many = many.join(members, ["group", "component"]).join(known, "id").select("token", "id", "n", "pos", "signature", "component", "main")
        a_b = F.expr("a.component <> b.component and (b.main or a.component < b.component)")
        met_many = (many.where("not main").alias("a").join(many.alias("b"), F.expr("a.token = b.token") & a_b & self._fits("a.", "b.")
                                                           & self._close("a.signature", "b.signature", "a.n", "b.n"))
                    .select(F.col("a.id").alias("u"), F.col("b.id").alias("v")))
        entities = entities.where(F.col("parts") <= FEW)
        met = (entities.where("not main").alias("a").join(entities.alias("b"), "token")
               .where(a_b).where(self._fits("a.", "b."))
               .select(F.col("a.group").alias("p"), F.col("a.component").alias("left"),
                       F.col("b.group").alias("q"), F.col("b.component").alias("right")).distinct())
        one = members.select(F.col("id").alias("u"), F.col("group").alias("p"), F.col("component").alias("left"))
        other = members.select(F.col("id").alias("v"), F.col("group").alias("q"), F.col("component").alias("right"))
        pairs = met.join(one, ["p", "left"]).join(other, ["q", "right"]).select("u", "v").unionByName(met_many)
        self._add(self._verify(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()))

    def result(self) -> DataFrame:
        """doc_id, row, n_shingles, component_id, component per row; component is null
        for empty sets."""
        named = stored(self.nodes.join(self.labels, "id").select("set_id", "component", "doc_id"), "named")
        least = stored(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
        of = stored(named.join(least, "component").select("set_id", "component", "component_id"), "components")
        linked = self.rows.where("n > 0").join(of, "set_id").select(
            "doc_id", "row", F.col("n").alias("n_shingles"), "component_id", "component")
        alone = self.rows.where("n = 0").select(
            "doc_id", "row", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
            F.lit(None).cast("long").alias("component"))
        return linked.unionByName(alone)


def _components(docs: DataFrame, key: str, text: str, row: str | None, k: int, percent: int, bits: int) -> DataFrame:
    if not 1 <= percent <= 100:
        raise ValueError("percent lies in 1..100")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                       (F.col(row).cast("long") if row else F.monotonically_increasing_id()).alias("row"))
    join = _Join(rows, k, percent, bits)
    join.star()
    for _ in range(ROUNDS):
        join.peel()
    join.rest()
    return join.result()


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", row: str | None = None,
                       k: int = 3, percent: int = 90, bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id and row per row of `docs`; `row` names a
    column of unique numbers, else rows are numbered here."""
    return _components(docs, key, text, row, k, percent, bits).select(
        F.col("doc_id").alias(key), "n_shingles", "component_id", "row")


def near_copies(docs: DataFrame, row: str, key: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90,
                bits: int = SKETCH_BITS) -> DataFrame:
    """The row numbers of all but one document of each component (the least id, then
    the least row number, stays; documents with empty sets all stay)."""
    found = stored(_components(docs, key, text, row, k, percent, bits).where("component is not null")
                   .select("component", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("at")), "members")
    stay = stored(found.groupBy("component").agg(F.min("at").alias("stay"))
                  .select("component", F.col("stay.row").alias("stay")), "stay")
    return found.join(stay, "component").where("at.row <> stay").select(F.col("at.row").alias(row))


@register("op5_ngram_join")
def op5_ngram_join(spark, sf_dir):
    """Components of 3-word-shingle similarity 0.9 over all `documents`."""
    return jaccard_components(table(spark, sf_dir, "documents")).drop("row")
