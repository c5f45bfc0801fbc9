"""Centroid clustering with bounds that follow the centroids (operator 13).

Every vector keeps an upper bound of the distance to its own centroid and a lower bound
of the distance to every other one.  When centroid j moves from p to q, a lower bound has
to give way by at most max(|x-p| - |x-q|) over the x of the cluster.  Those lie in
a sphere around their own centroid c (its radius: the largest upper bound).  With m
the middle of p and q, |x-p| + |x-q| >= 2|x-m|, so

    |x-p| - |x-q| = (|x-p|^2 - |x-q|^2) / (|x-p| + |x-q|) <= |q-p| cos(angle of x-m and q-p),

and in the plane of c, p and q the sphere spans the angles within asin(radius / |c-m|) of
c's.  The bound gives way by |q-p| times the cosine of the least of them: nothing where
the cluster lies behind the move, the full drift only where it lies ahead.  Vectors
whose bounds no longer prove their centroid are compared exactly with all centroids, in
64-bit integers; so results are those of a full scan.

State is a written table of blocks of vectors with their bounds, one table per round, so
a lost executor costs tasks.  A block also holds what its vectors' moves change in the
sums of the clusters; only those columns are read to add up, and what reaches the
driver is one sum per cluster and component.

Defined cases: vectors with a null, another number of components, or a null or
non-finite component are left out; repeated rows and ids are a row each; among equal
hashes the lesser vector starts; a null id hashes after all others; fewer vectors
than clusters: as many clusters as vectors; an empty table has no rows; components
must stay within 2^27 after scaling, else the job fails, as a distance would not
fit a long.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsieve.llm.common import register, shared_folder, stored, table

BLOCK = 512
LARGEST = 1 << 27
SLACK = 1e-9        # far above the rounding error of a bound, relative
STATE_DDL = ("ids array<bigint>, vectors binary, own binary, upper binary, lower binary, "
             "sums binary, counts binary, scanned bigint, held bigint")
STATE = pa.schema([("ids", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("vectors", "own", "upper", "lower", "sums", "counts")),
                   ("scanned", pa.int64()), ("held", pa.int64())])
BLOCK_DDL, BLOCK_ROW = "ids array<bigint>, vectors binary", pa.schema([("ids", pa.list_(pa.int64())), ("vectors", pa.binary())])


def loosening(center: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How much the distance to each row of `old` can exceed that to the same row of
    `new`, over all points within `radius` of `center`."""
    move = new - old
    drift = np.sqrt((move * move).sum(axis=1))
    away = center - (old + new) / 2
    far = np.sqrt((away * away).sum(axis=1))
    outside = (far > radius) & (drift > 0)
    far_, drift_ = np.where(outside, far, 1.0), np.where(drift > 0, drift, 1.0)
    angle = np.arccos(np.clip((away * move).sum(axis=1) / (far_ * drift_), -1, 1))
    nearest = np.maximum(angle - np.arcsin(np.minimum(radius / far_, 1.0)), 0.0)
    give = np.where(outside, drift * np.maximum(np.cos(nearest), 0.0), drift)
    return np.minimum(give + SLACK * drift, drift * (1 + SLACK))


def _down(x: np.ndarray) -> np.ndarray:
    """As 32-bit floats that are not above x."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, exact: (vectors x centroids) 64-bit integers."""
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        d = vectors - c
        out[:, j] = np.einsum("nd,nd->n", d, d)
    return out


@dataclass
class Block:
    """Vectors with their centroids and bounds."""
    vectors: np.ndarray     # int64 (n, dim)
    own: np.ndarray         # int32
    upper: np.ndarray       # float64
    lower: np.ndarray       # float32 (n, k)

    def full(self, rows: np.ndarray, centroids: np.ndarray) -> None:
        """Compare these rows with all centroids; equal distances: the smaller number."""
        if not len(rows):
            return
        d = distances(self.vectors[rows], centroids)
        self.own[rows] = d.argmin(axis=1)
        self.upper[rows] = np.sqrt(d.min(axis=1))
        self.lower[rows] = _down(np.sqrt(d) * (1 - SLACK))

    def loosen(self, old: np.ndarray, new: np.ndarray) -> None:
        """Bounds that hold for the moved centroids."""
        for i in np.unique(self.own):
            rows = np.flatnonzero(self.own == i)
            give = loosening(old[i], float(self.upper[rows].max()) * (1 + SLACK), old, new)
            self.lower[rows] = _down(self.lower[rows].astype(np.float64) - give)
        move = np.sqrt(((new - old) ** 2).sum(axis=1))
        self.upper += move[self.own] * (1 + SLACK)

    def unproven(self, rows: np.ndarray) -> np.ndarray:
        """Rows whose bounds allow another centroid."""
        lower = self.lower[rows].astype(np.float64)
        lower[np.arange(len(rows)), self.own[rows]] = np.inf
        return rows[~(self.upper[rows] * (1 + SLACK) < lower.min(axis=1))]

    def follow(self, old: np.ndarray, new: np.ndarray) -> int:
        """Centroids move from old to new; returns how many vectors were scanned."""
        self.loosen(old.astype(np.float64), new.astype(np.float64))
        rows = self.unproven(np.arange(len(self.own)))
        self.upper[rows] = self.exact(rows, new) ** 0.5      # first the own centroid alone
        rows = self.unproven(rows)
        self.full(rows, new)
        return len(rows)

    def exact(self, rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        d = self.vectors[rows] - centroids[self.own[rows]]
        return np.einsum("nd,nd->n", d, d)


def _blocks(dim: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, n = [], [], 0

        def row() -> pa.RecordBatch:
            v = np.concatenate(held)
            return pa.RecordBatch.from_arrays([pa.array([pa.concat_arrays(ids).to_pylist()], STATE.field("ids").type),
                                               pa.array([v.astype("<i4").tobytes()], pa.binary())], schema=BLOCK_ROW)

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = np.floor(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) * scale)
                if np.abs(x).max(initial=0) > LARGEST:
                    raise ValueError(f"a component beyond {LARGEST / scale}: its distance does not fit a long")
                ids.append(part.column(0))
                held.append(x.astype(np.int64))
                n += part.num_rows
                if n >= BLOCK:
                    yield row()
                    ids, held, n = [], [], 0
        if n:
            yield row()
    return run


def _read(batch: pa.RecordBatch, i: int, dim: int, k: int | None) -> Block:
    vectors = np.frombuffer(batch.column("vectors")[i].as_py(), "<i4").reshape(-1, dim).astype(np.int64)
    n = len(vectors)
    if k is None:
        return Block(vectors, np.zeros(n, np.int32), np.zeros(n), np.zeros((n, 0), np.float32))
    return Block(vectors, np.frombuffer(batch.column("own")[i].as_py(), "<i4").copy(),
                 np.frombuffer(batch.column("upper")[i].as_py(), "<f8").copy(),
                 np.frombuffer(batch.column("lower")[i].as_py(), "<f4").reshape(n, k).copy())


def _assign(old: np.ndarray | None, new: np.ndarray):
    """One assignment of all vectors; `old` is None in the first round."""
    k, dim = new.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = _read(batch, i, dim, None if old is None else k)
                n = len(b.own)
                sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
                if old is None:
                    b.lower = np.zeros((n, k), np.float32)
                    b.full(np.arange(n), new)
                    scanned, moved = n, np.arange(n)
                else:
                    before = b.own.copy()
                    scanned = b.follow(old, new)
                    moved = np.flatnonzero(before != b.own)
                    np.subtract.at(sums, before[moved], b.vectors[moved])
                    np.subtract.at(counts, before[moved], 1)
                np.add.at(sums, b.own[moved], b.vectors[moved])
                np.add.at(counts, b.own[moved], 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("ids")[i].as_py()], STATE.field("ids").type),
                     pa.array([batch.column("vectors")[i].as_py()], pa.binary()),
                     *(pa.array([x.tobytes()], pa.binary()) for x in (b.own.astype("<i4"), b.upper.astype("<f8"), b.lower.astype("<f4"))),
                     *(pa.array([x.tobytes() if x.any() else None], pa.binary()) for x in (sums, counts)),
                     pa.array([scanned], pa.int64()), pa.array([n], pa.int64())], schema=STATE)
    return run


SUM_ROW = pa.schema([("cluster", pa.int32()), ("held", pa.int64()), ("sums", pa.list_(pa.int64()))])


def _add_up(k: int, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for s, c in zip(batch.column("sums"), batch.column("counts")):
                sums += np.frombuffer(s.as_py(), np.int64).reshape(k, dim) if s.is_valid else 0
                counts += np.frombuffer(c.as_py(), np.int64) if c.is_valid else 0
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(counts), pa.array(list(sums), SUM_ROW.field("sums").type)],
                                         schema=SUM_ROW)
    return run


def _changes(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """What the last assignment changed in sums and counts (k x dim and k numbers)."""
    parts = state.select("sums", "counts").mapInArrow(_add_up(k, dim), "cluster int, held bigint, sums array<bigint>")
    sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
    per_component = parts.select("cluster", "held", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(
        F.sum("x").alias("x"), F.sum("held").alias("held"))
    for r in per_component.collect():
        sums[r["cluster"], r["at"]], counts[r["cluster"]] = r["x"], r["held"]
    return sums, counts


@dataclass
class Clusters:
    """Blocks of assigned vectors, the final centroids, and the share scanned in each round."""
    state: DataFrame
    centroids: np.ndarray
    scanned: list[float]


def usable(vectors: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """(id, vector) of the rows with `dim` finite components, as doubles."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.where(F.col(vector).isNotNull() & (F.size(v) == dim) & F.coalesce(finite, F.lit(False)))
            .select(F.col(key).cast("long").alias("id"), v.alias("vector")))


def first_centroids(kept: DataFrame, k: int, scale: int, salt: str) -> np.ndarray:
    """The k vectors with the least hash of their id."""
    h = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    rows = kept.select(h.alias("h"), "vector").orderBy(F.asc_nulls_last("h"), "vector").limit(k).collect()
    return np.array([[math.floor(x * scale) for x in r["vector"]] for r in rows], np.int64)


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dim: int = 64, k: int = 8,
            rounds: int = 10, scale: int = 1024, salt: str = "3:") -> Clusters | None:
    """Lloyd's rounds over all usable vectors; None where there are none."""
    spark = vectors.sparkSession
    kept = usable(vectors, key, vector, dim)
    new = first_centroids(kept, k, scale, salt)
    if not len(new):
        return None
    state = stored(kept.mapInArrow(_blocks(dim, scale), BLOCK_DDL), "vectors")
    folder, old, scanned = shared_folder(spark), None, []
    sums, counts = np.zeros(new.shape, np.int64), np.zeros(len(new), np.int64)
    for r in range(rounds + 1):
        path = f"{folder}/round-{r}"
        (state.mapInArrow(_assign(old, new), STATE_DDL).write.option("compression", "zstd")
              .option("parquet.block.size", 32 << 20).parquet(path))
        state = spark.read.schema(STATE_DDL).parquet(path)
        seen = state.agg(F.sum("scanned"), F.sum("held")).first()
        scanned.append(seen[0] / seen[1])
        if r < rounds:
            more, held = _changes(state, *new.shape)
            sums, counts, old = sums + more, counts + held, new
            new = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], old)
    return Clusters(state, new, scanned)


def _members(centroids: np.ndarray):
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = _read(batch, i, dim, k)
                yield pa.RecordBatch.from_arrays([batch.column("ids").slice(i, 1).flatten(), pa.array(b.own, pa.int32()),
                                                  pa.array(b.exact(np.arange(len(b.own)), centroids), pa.int64())],
                                                 names=["id", "cluster", "distance"])
    return run


def members(spark: SparkSession, found: Clusters | None, key: str = "vec_id") -> DataFrame:
    """One row per vector: key, cluster, squared distance, inertia of its cluster and of all, its centroid's hash."""
    ddl = f"{key} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if found is None:
        return spark.createDataFrame([], ddl)
    rows = stored(found.state.select("ids", "vectors", "own", "upper", "lower")
                  .mapInArrow(_members(found.centroids), "id long, cluster int, distance long"), "members")
    per = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}   # k rows
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    totals = spark.createDataFrame([(c, s, sum(per.values()), digest[c]) for c, s in per.items()],
                                   "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.withColumnRenamed("id", key).join(F.broadcast(totals), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(dim: int = 64, k: int = 8, rounds: int = 10, scale: int = 1024, salt: str = "3:") -> str:
    """The same clusters by full scans."""
    sql = [f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER () AS row
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
c0 AS MATERIALIZED (SELECT v, CAST(row_number() OVER (ORDER BY sha256('{salt}' || vec_id), v) - 1 AS BIGINT) AS c
  FROM kept QUALIFY c < {k})"""]
    for r in range(rounds + 1):
        sql.append(f"""a{r} AS MATERIALIZED (SELECT row, vec_id, v, m[1] AS d, m[2] AS c FROM (
  SELECT row, any_value(vec_id) AS vec_id, any_value(kept.v) AS v, min([CAST(list_sum(list_transform(list_zip(kept.v, c{r}.v),
    lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), c]) AS m FROM kept, c{r} GROUP BY row))""")
        if r < rounds:
            sql.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, coalesce(n.v, o.v) AS v FROM c{r} o LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i)
  GROUP BY c) n USING (c))""")
    return ",\n".join(sql) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)"""


@register("op13_centroid_clusters", _oracle())
def op13_centroid_clusters(spark, sf_dir):
    """Eight clusters of all `embeddings` after ten rounds."""
    return members(spark, cluster(table(spark, sf_dir, "embeddings")))
