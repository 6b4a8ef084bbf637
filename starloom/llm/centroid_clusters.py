"""Clustering of vectors around centroids, the nearest centroid found by the
threshold algorithm.

Components become integers, so every step is exact and repeatable. For each
dimension the centroids are listed in order of their component. A vector starts at
its own value in every list and walks outwards, one centroid of each list a round,
the nearer side first; a centroid met for the first time gets its exact distance.
Any centroid not met yet is at least as far in each dimension as the walk has come
there, so once the sum of squares of these frontier distances is strictly greater
than the best exact distance, no other centroid can be nearer or tie. Many vectors
walk at once, and those that are done leave.

Every round is one pass over the stored integers: tasks send the sums and counts of
each cluster and dimension (at most k x dims rows each), never vectors, so a
cluster that holds most rows is no hot key. Centroids (k x dims integers) go to the
tasks with the function.

Vectors that are null, of another length, or hold null or non-finite components are
left out; so are extra columns. Repeated rows count each time. A null vec_id takes
part; its hash is that of the empty string. Fewer vectors than k: as many
centroids; none: no rows. Components beyond 2**27 after scaling are an error, as
squared distances may not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, in_arrow, stored
from .vectors import matrix, packed, read_vectors, unpacked

LARGEST = 1 << 27
#: Vectors that walk at once.
STEP = 4096
_FAR = np.int64(1) << np.int64(62)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest row of `centroids` to every row of `x` (integers; a tie goes to
    the lesser number) and its squared distance."""
    n, (k, size) = len(x), centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, 0)
    dims = np.arange(size)
    above = np.empty((n, size), np.int64)
    for d in range(size):
        above[:, d] = np.searchsorted(lists[:, d], x[:, d])
    below = above - 1
    best, which = np.full(n, _FAR), np.full(n, k)
    met = np.zeros((n, k), bool)
    rows = np.arange(n)
    while len(rows):
        down = np.where(below >= 0, x[rows] - lists[np.maximum(below, 0), dims], _FAR)
        up = np.where(above < k, lists[np.minimum(above, k - 1), dims] - x[rows], _FAR)
        lower = down <= up
        frontier = np.minimum(down, up)
        here = np.zeros((len(rows), k), bool)
        here[np.arange(len(rows))[:, None], order[np.where(lower, below, above), dims]] = True
        here &= ~met[rows]
        met[rows] |= here
        for j in range(k):
            r = rows[here[:, j]]
            gap = x[r] - centroids[j]
            apart = (gap * gap).sum(1)
            better = (apart < best[r]) | ((apart == best[r]) & (j < which[r]))
            best[r[better]], which[r[better]] = apart[better], j
        on = ((frontier * frontier).sum(1) <= best[rows]) & ~met[rows].all(1)
        below, above = (below - lower)[on], (above + ~lower)[on]
        rows = rows[on]
    return which, best


def _integers(dims: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, size, values, first = read_vectors(batch.column(1))
            keep = np.flatnonzero(ok & (size == dims))
            x = np.floor(scale * matrix(values, first[keep], dims))
            if len(x) and np.abs(x).max() > LARGEST:
                raise ValueError(f"a component times {scale} is beyond {LARGEST}: squared distances may not fit a long")
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), packed(x.astype("<i4"))],
                                             ["vec_id", "vector"])
    return run


def _walk(column: pa.Array, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(vectors, clusters, distances), a step at a time."""
    x = unpacked(column, centroids.shape[1], "<i4")
    for lo in range(0, len(x), STEP):
        part = x[lo:lo + STEP].astype(np.int64)
        yield part, *nearest(part, centroids)


def _sums(centroids: np.ndarray):
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for x, cluster, _ in _walk(batch.column(0), centroids):
                count += np.bincount(cluster, minlength=k)
                for j in range(k):
                    total[j] += x[cluster == j].sum(0)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, size)), pa.array(np.tile(np.arange(size), len(some))),
             pa.array(total[some].ravel()), pa.array(np.repeat(count[some], size))],
            ["cluster", "dim", "total", "n"])
    return run


def _assign(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            for x, cluster, apart in _walk(batch.column(1), centroids):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(x)), pa.array(cluster.astype(np.int32)), pa.array(apart)],
                    ["vec_id", "cluster", "distance"])
                lo += len(x)
    return run


def first_centroids(points: DataFrame, k: int, dims: int, seed: int) -> np.ndarray:
    """The k vectors of least sha256 of `seed:vec_id`, in that order (k rows reach
    the driver); rows of one vec_id in the order of their bytes."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.select(key.alias("key"), "vector").orderBy("key", "vector").limit(k).collect()
    return np.array([np.frombuffer(r.vector, "<i4") for r in rows], np.int64).reshape(len(rows), dims)


def moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floors of the means of their vectors, an empty
    one as it was."""
    exact = F.sum(F.col("total").cast("decimal(38,0)"))
    sums = (in_arrow(points.select("vector"), _sums(centroids), "cluster long, dim long, total long, n long")
            .groupBy("cluster", "dim").agg(exact.alias("total"), F.sum("n").alias("n")))
    out = centroids.copy()
    for row in sums.collect():  # k x dims rows at most
        out[row.cluster, row.dim] = int(row.total) // row.n
    return out


def cluster(vectors: DataFrame, k: int = 8, dims: int = 64, rounds: int = 10, scale: int = 1024,
            seed: int = 3) -> DataFrame:
    """`vectors` has vec_id and embedding. Returns (vec_id, cluster, distance,
    cluster_inertia, inertia, centroid_sha256) of every vector of `dims` finite
    components, taken as floor(scale * x): its cluster after `rounds` rounds, the
    squared distance to the centroid, the sums of these over the cluster and over
    all, and the sha256 of the centroid's components joined by commas."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    points = stored(in_arrow(rows, _integers(dims, scale), "vec_id long, vector binary"), "integers")
    centroids = first_centroids(points, k, dims, seed)
    out = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return spark.createDataFrame([], out + ", cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(points, centroids)
    assigned = stored(in_arrow(points, _assign(centroids), out), "clusters")
    forget(points)
    inertia = {r.cluster: r.total for r in  # k rows at most
               assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    about = [(j, n, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest())
             for j, n in inertia.items()]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", *about.columns[1:])
