"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on SAMPLE vectors (those of least hash) and placed in every
task; every vector is indexed in the leaf it comes to. A query walks the tree best
bin first: down to the nearest leaf, then on from the nearest node that a priority
queue holds. How many leaves it visits is calibrated: for CALIBRATION vectors the
true neighbours are found by brute force over the whole index, and visits are
widened until the leaves visited hold GOAL of them. The measured share is a lower
bound in practice only: other queries may fare a little worse or better.

Equal vectors are one candidate with the k + 1 least ids, which is all that any
answer can need, and one query. Leaves are gathered into groups of about TILE
vectors, larger leaves are dealt over several, and the queries of a group over
tiles of ASKED, so no task depends on how many vectors or queries a leaf has. A
tile scans each leaf for the queries that visit it and sends the k + 1 nearest of
each; distances of what is sent are computed in double precision from the vectors
as they are.

Vectors of different lengths are never compared: each length has its own tree (one
leaf if the sample holds none of it). Null ids, and vectors that are null, empty,
zero or hold null or non-finite components, take no part. A row repeated with the
same id and vector is one row; one id with several vectors asks with each, and its
other vectors are candidates. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, in_arrow, ship_package, stored
from .kmeans_tree import Tree
from .vectors import matrix, packed, read_vectors, unpacked

#: Vectors that the tree is fitted on, and vectors that calibrate the search.
SAMPLE, CALIBRATION = 16384, 256
#: Share of the true neighbours that the leaves visited are to hold.
GOAL = 0.97
#: Vectors of a group of leaves, queries of a tile, partial rows of one query class.
TILE, ASKED = 8192, 1024
#: Allowance for rounding in distances that were computed by a matrix product.
SLACK = 1e-9
_PARTS = 64


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, dims, vector) of the vectors that take part, in single precision
    where that loses nothing."""
    for batch in batches:
        ok, size, values, first = read_vectors(batch.column(1))
        values = values + 0.0
        full = np.r_[0, np.cumsum(values != 0)]
        end = np.minimum(first + size, len(values))
        ok &= (full[end] > full[np.minimum(first, len(values))]) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            lossy = np.r_[0, np.cumsum(values.astype("<f4") != values)]
        wide = lossy[end] > lossy[np.minimum(first, len(values))]
        for d in np.unique(size[ok]):
            for kind, here in (("<f4", ~wide), ("<f8", wide)):
                rows = np.flatnonzero(ok & here & (size == d))
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), d, np.int32)),
                         packed(matrix(values, first[rows], d).astype(kind))], ["vec_id", "dims", "vector"])


def vectors_of(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of `size` components, stored in single or double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1])
    out = np.empty((len(column), size))
    for kind, width in (("<f4", 4 * size), ("<f8", 8 * size)):
        rows = np.flatnonzero(length == width)
        if len(rows):
            out[rows] = unpacked(column.take(pa.array(rows)), size, kind)
    return out


def _by_length(batch: pa.RecordBatch, dims: str, vector: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dims, rows, vectors) for every length in the batch."""
    size = batch.column(dims).to_numpy()
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        yield d, rows, vectors_of(batch.column(vector).take(pa.array(rows)), d)


def _place(trees: dict[int, Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int32)
            for d, rows, x in _by_length(batch, "dims", "vector"):
                if d in trees:
                    leaf[rows] = trees[d].place(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])
    return run


def closest(q: np.ndarray, x: np.ndarray, lead: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the `keep` rows of x nearest to each row of q, ties
    to the lesser `lead`. A matrix product finds whom to measure exactly."""
    about = (q * q).sum(1)[:, None] + (x * x).sum(1) - 2 * (q @ x.T)
    at = min(keep, len(x)) - 1
    edge = np.partition(about, at, axis=1)[:, at]
    slack = SLACK * ((q * q).sum(1) + (x * x).sum(1).max())
    i, j = np.nonzero(~(about > (edge + slack)[:, None]))  # an overflow is measured too
    gap = x[j] - q[i]
    apart = np.sqrt((gap * gap).sum(1))
    order = np.lexsort((lead[j], apart, i))
    i, j, apart = i[order], j[order], apart[order]
    first = np.searchsorted(i, np.arange(len(q)))
    near = np.arange(len(i)) - first[i] < keep
    return i[near], j[near], apart[near]


def _true_neighbours(asked: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """For calibration vectors (by length: classes and vectors) the k nearest other
    classes of a task, with their leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            cls, leaf = batch.column("cls").to_numpy(), batch.column("leaf").to_numpy()
            for d, rows, x in _by_length(batch, "dims", "vector"):
                if d not in asked:
                    continue
                own, q = asked[d]
                i, j, apart = closest(q, x, cls[rows], k + 1)
                j = rows[j]
                other = own[i] != cls[j]
                new = np.rec.fromarrays([own[i][other], apart[other], cls[j][other], leaf[j][other]],
                                        names="asked,apart,cls,leaf")
                new = np.concatenate([best[d], new]) if d in best else new
                new = new[np.lexsort((new["cls"], new["apart"], new["asked"]))]
                first = np.flatnonzero(np.r_[True, new["asked"][1:] != new["asked"][:-1]]) if len(new) else []
                count = np.diff(np.r_[first, len(new)]).astype(np.int64)
                best[d] = new[np.arange(len(new)) - np.repeat(first, count).astype(np.int64) < k]
        for found in best.values():
            yield pa.RecordBatch.from_arrays([pa.array(found[c].copy()) for c in ("asked", "apart", "cls", "leaf")],
                                             ["asked", "apart", "cls", "leaf"])
    return run


def _collected(rows: list, size: int) -> np.ndarray:
    return vectors_of(pa.array([r.vector for r in rows], pa.binary()), size)


def fit(classes: DataFrame) -> dict[int, Tree]:
    """A tree for each length among the SAMPLE vectors of least hash."""
    rows = classes.select("dims", "vector").orderBy(F.xxhash64("vector", F.lit(5)), "vector").limit(SAMPLE).collect()
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(row.dims, []).append(row)
    return {d: Tree(_collected(some, d), d) for d, some in by_length.items()}


def calibrate(index: DataFrame, trees: dict[int, Tree], held: dict[int, np.ndarray], k: int) -> dict[int, tuple[int, float]]:
    """By length: how many leaves to visit, and the share of true neighbours that
    these hold. All vectors of the index are compared with the CALIBRATION ones."""
    rows = index.select("cls", "dims", "vector").orderBy(F.xxhash64("vector", F.lit(9)), "vector").limit(CALIBRATION).collect()
    asked = {}
    for d in {r.dims for r in rows}:
        some = [r for r in rows if r.dims == d]
        asked[d] = np.array([r.cls for r in some]), _collected(some, d)
    near = Window.partitionBy("asked").orderBy("apart", "cls")
    found = (in_arrow(index.select("cls", "dims", "vector", "leaf"), _true_neighbours(asked, k),
                      "asked long, apart double, cls long, leaf int")
             .withColumn("at", F.row_number().over(near)).filter(F.col("at") <= k).select("asked", "leaf").collect())
    out = {}
    for d, (own, q) in asked.items():
        tree = trees.get(d)
        if tree is None:
            continue
        place = {}
        for c, leaves in zip(own.tolist(), tree.order(q, tree.n_leaves, 0, held[d])):
            place.update({(c, leaf): i for i, leaf in enumerate(leaves)})
        at = np.array([place[r.asked, r.leaf] for r in found if (r.asked, r.leaf) in place])
        visits = 1
        while visits < tree.n_leaves and len(at) and (at < visits).mean() < GOAL:
            visits += max(1, visits // 8)
        out[d] = min(visits, tree.n_leaves), float((at < visits).mean()) if len(at) else 1.0
    return out


def _visits(trees: dict[int, Tree], visits: dict[int, int], held: dict[int, np.ndarray],
            group: dict[int, np.ndarray], k: int):
    """For each query class one row for every group of leaves that it visits any of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, groups, leaves = [], [], []
            for d, rows, x in _by_length(batch, "dims", "vector"):
                tree = trees.get(d)
                paths = tree.order(x, visits.get(d, tree.n_leaves), k + 1, held[d]) if tree else [[0]] * len(rows)
                for row, path in zip(rows.tolist(), paths):
                    path = np.sort(np.array(path))
                    where = group[d][path]
                    some, first = np.unique(where, return_index=True)
                    at += [row] * len(some)
                    groups += some.tolist()
                    leaves += np.split(path, first[1:])
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups, pa.int32()), pa.array([p.tolist() for p in leaves], pa.list_(pa.int32())),
                 *(batch.column(c).take(take) for c in ("cls", "dims", "vector"))],
                ["part", "leaves", "cls", "dims", "vector"])
    return run


def _scan(k: int):
    """One tile: the k + 1 nearest classes of each query in the leaves it visits."""
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        names = {"asked": pa.int64(), "score": pa.float64(), "cls": pa.int64(), "ids": pa.list_(pa.int64())}
        out = []
        if rows.num_rows and asked.num_rows:
            rows = rows.sort_by([("leaf", "ascending")]).combine_chunks()
            size = rows["dims"][0].as_py()
            x, q = vectors_of(rows["vector"], size), vectors_of(asked["vector"], size)
            leaf = rows["leaf"].to_numpy()
            lead = pa.compute.list_element(rows["ids"], 0).to_numpy()
            own, cls = asked["cls"].to_numpy(), rows["cls"].to_numpy()
            lists = asked["leaves"].combine_chunks()
            visited, visitor = lists.flatten().to_numpy(), pa.compute.list_parent_indices(lists).to_numpy()
            found = []
            for number in np.unique(leaf):
                lo, hi = np.searchsorted(leaf, [number, number + 1])
                who = visitor[visited == number]
                if len(who):
                    i, j, apart = closest(q[who], x[lo:hi], lead[lo:hi], k + 1)
                    found.append((who[i], lo + j, apart))
            if found:
                i, j, apart = (np.concatenate(part) for part in zip(*found))
                order = np.lexsort((lead[j], apart, i))
                i, j, apart = i[order], j[order], apart[order]
                near = np.arange(len(i)) - np.searchsorted(i, i) < k + 1
                i, j, apart = i[near], j[near], apart[near]
                out = [pa.array(own[i]), pa.array(apart), pa.array(cls[j]),
                       rows["ids"].combine_chunks().take(pa.array(j))]
        return pa.table(out or [pa.array([], t) for t in names.values()], schema=pa.schema(list(names.items())))
    return run


def _groups(counts: dict[tuple[int, int], int], trees: dict[int, Tree]):
    """Leaves gathered in their order into groups of about TILE vectors: by length
    the rows and the group of each leaf, and how many tiles each group's rows fill."""
    held, group, tiles = {}, {}, []
    for d in sorted({d for d, _ in counts}):
        n = trees[d].n_leaves if d in trees else 1
        held[d] = np.array([counts.get((d, leaf), 0) for leaf in range(n)], np.int64)
        group[d] = np.zeros(n, np.int64)
        filled = TILE
        for leaf, rows in enumerate(held[d].tolist()):
            if filled + rows > TILE:
                tiles.append(0)
                filled = 0
            filled += rows
            group[d][leaf] = len(tiles) - 1
            tiles[-1] = -(-filled // TILE)
    return held, group, [max(t, 1) for t in tiles]


def _group_of(group: dict[int, np.ndarray], trees_group: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, leaf = batch.column("dims").to_numpy(), batch.column("leaf").to_numpy()
            part = np.zeros(batch.num_rows, np.int32)
            for d in np.unique(size).tolist():
                part[size == d] = group[d][leaf[size == d]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(part), pa.array(np.array(trees_group, np.int32)[part])],
                [*batch.schema.names, "part", "tiles"])
    return run


def vector_classes(vectors: DataFrame, k: int) -> DataFrame:
    """(cls, dims, vector, ids): every different vector once, with its k + 1 least ids."""
    # A vector that a large share of the rows has is reduced by parts first.
    by_part = Window.partitionBy("dims", "vector", "part").orderBy("vec_id")
    by_vector = Window.partitionBy("dims", "vector").orderBy("vec_id")
    few = (vectors.distinct().withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(_PARTS)))
           .withColumn("at", F.row_number().over(by_part)).filter(F.col("at") <= k + 1)
           .withColumn("at", F.row_number().over(by_vector)).filter(F.col("at") <= k + 1))
    return stored(few.groupBy("dims", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                  .withColumn("cls", F.monotonically_increasing_id()), "vector-classes")


def search(vectors: DataFrame, asks, k: int = 10) -> DataFrame:
    """`vectors` has vec_id and embedding; `asks` is a condition on vec_id that says
    which rows are queries. Returns (query_id, rank, vec_id, score): the k nearest
    other rows found for each query, rank from 1, score their Euclidean distance."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(in_arrow(rows, _read, "vec_id long, dims int, vector binary"), "vectors")
    classes = vector_classes(rows, k)
    trees = fit(classes)
    kept = "cls long, dims int, vector binary, ids array<long>, leaf int"
    index = stored(in_arrow(classes.select("cls", "dims", "vector", "ids"), _place(trees), kept), "tree-index")
    counts = {(r.dims, r.leaf): r["count"] for r in  # one row for each leaf
              index.groupBy("dims", "leaf").count().collect()}
    held, group, tiles = _groups(counts, trees)
    visits = {d: n for d, (n, _) in calibrate(index, trees, held, k).items()}

    # The ids that ask, in parts, so that a vector that many ids have is no hot key.
    asking = (rows.filter(asks).groupBy("dims", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(_PARTS)).alias("part"))
              .agg(F.collect_set("vec_id").alias("askers")).drop("part"))
    asked = classes.join(asking.select("dims", "vector").distinct(), ["dims", "vector"])
    walked = stored(in_arrow(asked.select("cls", "dims", "vector"), _visits(trees, visits, held, group, k),
                             "part int, leaves array<int>, cls long, dims int, vector binary"), "tree-visits")
    asked_tiles = {r.part: -(-r["count"] // ASKED) for r in  # one row for each group
                   walked.groupBy("part").count().collect()}
    of_group = spark.createDataFrame([(p, t, asked_tiles.get(p, 0)) for p, t in enumerate(tiles)],
                                     "part int, tiles int, asked_tiles int")
    of_group = F.broadcast(of_group)  # one row for each group
    every = F.explode(F.sequence(F.lit(0), F.col("other") - 1))
    grouped = in_arrow(index, _group_of(group, tiles), kept + ", part int, tiles int").drop("tiles")
    held_rows = (grouped.join(of_group, "part").filter("asked_tiles > 0").withColumn("other", F.col("asked_tiles"))
                 .withColumn("i", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int")).withColumn("j", every)
                 .select("part", "i", "j", "cls", "dims", "leaf", "ids", "vector"))
    asking_rows = (walked.join(of_group, "part").withColumn("other", F.col("tiles"))
                   .withColumn("j", F.pmod(F.xxhash64("cls"), F.col("asked_tiles")).cast("int")).withColumn("i", every)
                   .select("part", "i", "j", "cls", "dims", "leaves", "vector"))
    found = stored(held_rows.groupBy("part", "i", "j").cogroup(asking_rows.groupBy("part", "i", "j"))
                   .applyInArrow(_scan(k), "asked long, score double, cls long, ids array<long>"), "tree-found")
    near = Window.partitionBy("asked").orderBy("score", F.col("ids")[0])
    best = (found.withColumn("at", F.row_number().over(near)).filter(F.col("at") <= k + 1)
            .select("asked", F.explode(F.transform("ids", lambda i: F.struct(
                F.col("score").alias("score"), i.alias("vec_id"),
                (F.col("cls") == F.col("asked")).alias("own")))).alias("row"))
            .groupBy("asked").agg(F.slice(F.sort_array(F.collect_list("row")), 1, k + 1).alias("best")))
    answers = (classes.select(F.col("cls").alias("asked"), "dims", "vector").join(best, "asked")
               .join(asking, ["dims", "vector"]).select(F.explode("askers").alias("query_id"), "best"))
    others = F.slice(F.filter("best", lambda r: ~(r.own & (r.vec_id == F.col("query_id")))), 1, k)
    out = stored(answers.select("query_id", F.posexplode(others).alias("rank", "row")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("row.vec_id").alias("vec_id"),
        F.col("row.score").alias("score")), "neighbours")
    forget(rows, classes, index, walked, found)
    return out
