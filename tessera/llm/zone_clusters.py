"""Centroid clustering (exact Lloyd rounds) over zone maps of a Hilbert curve.

Vectors become integers and are ordered along a Hilbert curve; runs of
``BLOCK`` vectors form blocks that carry the smallest and greatest value of
each component (a zone map), their sum and their vectors. In each round the
distances from a centroid to the nearest and to the farthest point of a
block's box bound all its vectors: a centroid whose nearest point is beyond
another's farthest cannot win. A block with one candidate left adds its stored
sum; the vectors of the others are compared with their candidates, exactly and
at once. A task returns sums a cluster, so a round moves k rows a task.

Rows and edge cases: a vector takes part if it has exactly ``dims`` components,
none null or non-finite. A component x is floor(1024 x), held within ±2**27 so
that every squared distance fits 64 bits. Starts are the k vectors of smallest
sha256 of ``seed:vec_id`` (a null id counts as empty; ties of repeated ids by
the vector). Equal vectors and ids count each. Fewer than k vectors give fewer
centroids, none give no rows. Other columns are not read.

The curve orders rows by the quartiles of a normal distribution in each
component; its order (and the salt that cuts runs of equal vectors) decides
the work, never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

#: Vectors of a block.
BLOCK = 256
#: Scale of the integers and the bound of their size.
SCALE, LIMIT = 1024, 1 << 27
#: Integers below this are compared in doubles: 64 squared differences stay below 2**53.
EXACT_DOUBLE = 1 << 22

ASSIGNED = "vec_id long, cluster int, distance long"
RESULT = ASSIGNED + ", cluster_inertia long, inertia long, centroid_sha256 string"


def integers(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id, v array<int>) of the vectors that take part."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(
        x.cast("double") * SCALE, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    return vectors.filter((F.size("embedding") == dims) & usable).select("vec_id", scaled.alias("v"))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve (rows of big-endian bytes) of points with ``bits`` bits a component."""
    x = cells.T.astype(np.uint8).copy()
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of each level's cubes, from the largest down
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & (q - 1)).astype(np.uint8)
            x[0] ^= np.where(turned, q - 1, swap).astype(np.uint8)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    q = top
    while q > 1:
        flips ^= np.where(x[n - 1] & q, q - 1, 0).astype(np.uint8)
        q >>= 1
    x ^= flips
    planes = [(x >> b) & 1 for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def build_blocks(vectors: DataFrame, dims: int) -> DataFrame:
    """Blocks of the curve's order: ids, vectors, box and sum, written to the shared folder."""
    spark = vectors.sparkSession
    ints = integers(vectors, dims)
    stats = ints.agg(*[f(F.col("v")[i]).alias(f"{f.__name__}{i}") for f in (F.avg, F.stddev_pop) for i in range(dims)]).first()
    mean = np.array([stats[f"avg{i}"] or 0.0 for i in range(dims)])
    step = 0.6745 * np.array([stats[f"stddev_pop{i}"] or 0.0 for i in range(dims)])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column("v"), dims)
            cells = (m > mean - step).astype(np.uint8) + (m > mean) + (m > mean + step)
            keys = hilbert_keys(cells, 2)
            yield pa.record_batch([b.column("vec_id"), b.column("v"), pa.array([k.tobytes() for k in keys], pa.binary())],
                                  ["vec_id", "v", "place"])

    placed = ints.mapInArrow(place, "vec_id long, v array<int>, place binary")
    placed = common.materialise(placed.withColumn("salt", F.monotonically_increasing_id()), "hilbert")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.rows_of(batches, BLOCK):
            m = _matrix(b.column("v"), dims)
            box = np.stack([m.min(0), m.max(0)])
            yield pa.record_batch([
                pa.array([len(m)], pa.int64()), pa.array([box.astype("<i4").tobytes()], pa.binary()),
                pa.array([m.sum(0).astype("<i8").tobytes()], pa.binary()),
                pa.array([b.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([m.astype("<i4").tobytes()], pa.binary())], ["n", "box", "total", "ids", "vectors"])

    common.batch_rows(spark, 4 * BLOCK)
    ordered = placed.repartitionByRange(common.n_partitions(spark), "place", "salt").sortWithinPartitions("place", "salt")
    return common.materialise(
        ordered.select("vec_id", "v").mapInArrow(pack, "n long, box binary, total binary, ids array<long>, vectors binary"),
        "zones")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some point of the box."""
    near = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    return np.flatnonzero((near * near).sum(1) <= (far * far).sum(1).min())


def nearest(m: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of the nearest centroid (ties: the first) and its exact squared distance, for each vector."""
    if max(np.abs(m).max(), np.abs(centroids).max()) < EXACT_DOUBLE:
        x, c = m.astype(np.float64), centroids.astype(np.float64)
        d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    else:
        d = np.stack([((m - c) ** 2).sum(1) for c in centroids], axis=1)
    best = d.argmin(1)
    return best, d[np.arange(len(m)), best].astype(np.int64)


def _zones(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple]:
    for b in batches:
        for r in range(b.num_rows):
            box = np.frombuffer(b.column("box")[r].as_py(), "<i4").astype(np.int64).reshape(2, dims)
            yield b, r, box


def _vectors(b: pa.RecordBatch, r: int, dims: int) -> np.ndarray:
    return np.frombuffer(b.column("vectors")[r].as_py(), "<i4").astype(np.int64).reshape(-1, dims)


def _round(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Exact size and component sums of each cluster under ``centroids``."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b, r, box in _zones(batches, dims):
            may = candidates(box[0], box[1], centroids)
            if len(may) == 1:
                size[may[0]] += b.column("n")[r].as_py()
                total[may[0]] += np.frombuffer(b.column("total")[r].as_py(), "<i8")
                continue
            m = _vectors(b, r, dims)
            won = may[nearest(m, centroids[may])[0]]
            for c in np.unique(won):
                size[c] += (won == c).sum()
                total[c] += m[won == c].sum(0)
        c, d = np.nonzero(np.repeat(size[:, None] > 0, dims, axis=1))
        yield pa.record_batch([pa.array(c.astype(np.int32)), pa.array(d.astype(np.int32)), pa.array(size[c]),
                               pa.array(total[c, d])], ["cluster", "dim", "n", "total"])

    partial = blocks.select("n", "box", "total", "vectors").mapInArrow(sums, "cluster int, dim int, n long, total long")
    found: dict[int, tuple[int, list[int]]] = {}
    for row in partial.groupBy("cluster", "dim").agg(
            F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        found.setdefault(row["cluster"], (row["n"], [0] * dims))[1][row["dim"]] = int(row["total"])
    return found


def starts(vectors: DataFrame, k: int, seed: str, dims: int) -> np.ndarray:
    """The k vectors whose ``seed:vec_id`` has the smallest sha256, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = integers(vectors, dims).orderBy(F.sha2(name.cast("binary"), 256), "v").select("v").limit(k).collect()
    return np.array([r["v"] for r in chosen], np.int64).reshape(-1, dims)


def fit(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3", dims: int = 64) -> tuple[DataFrame, np.ndarray]:
    """The blocks of ``vectors`` (vec_id, embedding) and their centroids after ``rounds`` rounds.

    Only k centroids and their k * dims sums reach the driver.
    """
    common.prepare(vectors.sparkSession)
    centroids = starts(vectors, k, seed, dims)
    blocks = build_blocks(vectors, dims)
    common.batch_rows(vectors.sparkSession, 16)
    for _ in range(rounds if len(centroids) else 0):
        for c, (n, total) in _round(blocks, centroids).items():
            centroids[c] = [t // n for t in total]
    return blocks, centroids


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector of the blocks."""
    dims = centroids.shape[1]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, r, box in _zones(batches, dims):
            may = candidates(box[0], box[1], centroids)
            won, distance = nearest(_vectors(b, r, dims), centroids[may])
            yield pa.record_batch([b.column("ids")[r].values, pa.array(may[won].astype(np.int32)), pa.array(distance)],
                                  ["vec_id", "cluster", "distance"])

    return blocks.select("box", "ids", "vectors").mapInArrow(label, ASSIGNED)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3", dims: int = 64) -> DataFrame:
    """Each vector's cluster and distance, the inertia of its cluster and of all, and its centroid's digest.

    An inertia beyond 64 bits is null.
    """
    spark = vectors.sparkSession
    blocks, centroids = fit(vectors, k, rounds, seed, dims)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    assigned = common.materialise(assign(blocks, centroids), "clusters")
    inertia = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    long = lambda x: x if x < 1 << 63 else None
    rows = [(c, long(total), long(sum(inertia.values())),
             hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
            for c, total in inertia.items()]
    of_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of_cluster), "cluster").select(  # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
