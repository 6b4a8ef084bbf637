"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors are scaled to length 1 and rotated by a fixed random rotation, then cut
into blocks of BLOCK dimensions. Two vectors of cosine c are sqrt(2 - 2c) apart,
so in at least one of m blocks their squared distance is at most (2 - 2c) / m:
each block is range-joined under that budget, and the union over the blocks
misses no pair.

A block's range join is a grid over its first GRID coordinates with cells
CELL radii wide: each vector is at home in one cell and visits the cells within
a radius of it, so each pair near in the block meets in the home cell of its
lesser id. A cell of more than TILE rows is cut into tiles of homes and visitors,
so no task gets an unbounded group. Inside, pairs under the
budget that were not already under it in an earlier block are confirmed by the
cosine in double precision; what leaves a task is a count of links for each
vector and links that join the vectors found connected there, never all pairs.

Equal vectors of a label are one vector with a weight. Null labels or ids,
vectors that are null, empty, zero, or hold null or non-finite components, link
with nothing; vectors of different lengths are compared among equals of length
only. Repeated rows count each time; rows of one vec_id share their links.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, ship_package, stored
from .components import components

BLOCK, GRID, CELL = 16, 2, 3.0
TILE = 4096
#: Allowance for rounding in budgets, and for single precision in the first look.
SLACK = 1e-5
_SIZE = 1024  # rows of one matrix product


def rotation(size: int) -> np.ndarray:
    """A fixed random rotation of `size` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(20240229).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _unit(rows: list[bytes], size: int) -> np.ndarray:
    """Vectors of `size` components, stored in single or double precision."""
    if len({len(r) for r in rows}) > 1:
        x = np.stack([np.frombuffer(r, "<f4" if len(r) == 4 * size else "<f8") for r in rows])
    else:
        x = np.frombuffer(b"".join(rows), "<f4" if len(rows[0]) == 4 * size else "<f8").reshape(len(rows), size)
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _radius(size: int, cosine: float) -> float:
    return float(np.sqrt((2 - 2 * cosine) / -(-size // BLOCK) + SLACK))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, components, vector or null if it cannot link). A vector
    is stored in single precision where that loses nothing."""
    for batch in batches:
        labels, vectors = batch.column(1), batch.column(2)
        out, size = [], []
        for label, v in zip(labels.to_pylist(), vectors):
            x = None if v.values is None else v.values
            ok = label is not None and x is not None and len(x) and not x.null_count
            y = x.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0 if ok else None
            ok = ok and np.isfinite(y).all() and y.any()
            with np.errstate(over="ignore"):
                single = y.astype("<f4") if ok else None
            out.append(None if not ok else (single if (single == y).all() else y).tobytes())
            size.append(len(y) if ok else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), labels, pa.array(size, pa.int32()), pa.array(out, pa.binary())],
            ["vec_id", "label", "dims", "vector"])


def _cells(cosine: float):
    """A row for each block and cell that a vector is at home in or visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(4).to_numpy()
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                x = _unit(batch.column(2).take(pa.array(rows)).to_pylist(), d) @ rotation(d)
                radius = _radius(d, cosine)
                for b in range(-(-int(d) // BLOCK)):
                    grid = x[:, b * BLOCK:b * BLOCK + min(BLOCK, GRID)][:, :GRID] / (CELL * radius)
                    home = np.floor(grid).astype(np.int64)
                    near = 1 / CELL
                    for step in itertools.product((-1, 0, 1), repeat=grid.shape[1]):
                        s = np.array(step)
                        ok = np.where(s < 0, grid - home <= near, np.where(s > 0, home + 1 - grid <= near, True)).all(1)
                        at = np.flatnonzero(ok)
                        if not len(at):
                            continue
                        cell = [f"{d}:{b}:" + ",".join(map(str, c)) for c in (home[at] + s).tolist()]
                        take = pa.array(rows[at])
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(take), batch.column(1).take(take), pa.array(cell),
                             pa.array(np.full(len(at), b, np.int32)), pa.array(np.full(len(at), not s.any())),
                             batch.column(3).take(take), batch.column(2).take(take), batch.column(4).take(take)],
                            ["id", "label", "cell", "block", "home", "weight", "vector", "dims"])
    return run


def _apart(y: np.ndarray, i: np.ndarray, j: np.ndarray, b: int) -> np.ndarray:
    """Squared distances in block b of the pairs (i, j)."""
    gap = y[i, b * BLOCK:(b + 1) * BLOCK] - y[j, b * BLOCK:(b + 1) * BLOCK]
    return (gap * gap).sum(1)


def _roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of a[i] and b[i]; a root is the least of its tree."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]


def _join(cosine: float):
    """Within one tile: counts of links and connecting links."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id").combine_chunks()
        block, size = table["block"][0].as_py(), table["dims"][0].as_py()
        lead = table["lead"].to_numpy(zero_copy_only=False)
        ids, weight = table["id"].to_numpy(), table["weight"].to_numpy()
        x = _unit(table["vector"].chunk(0).to_pylist(), size)
        budget = (2 - 2 * cosine) / -(-size // BLOCK) + SLACK
        y = x @ rotation(size)
        part = np.ascontiguousarray(y[:, block * BLOCK:(block + 1) * BLOCK]).astype(np.float32)
        square = (part * part).sum(1)
        n_links = np.zeros(len(ids), np.int64)
        # Equal ids (one row as a home, one as a visitor) share their first place.
        root = np.searchsorted(ids, ids)
        homes, visitors = np.flatnonzero(lead), np.flatnonzero(~lead)
        for lo in range(0, len(homes), _SIZE):
            h = homes[lo:lo + _SIZE]
            for at in range(0, len(visitors), _SIZE):
                o = visitors[at:at + _SIZE]
                if ids[o[-1]] <= ids[h[0]]:
                    continue
                apart = square[h][:, None] + square[o] - 2 * (part[h] @ part[o].T)
                i, j = np.nonzero((apart <= budget + SLACK) & (ids[h][:, None] < ids[o]))
                i, j = h[i], o[j]
                # A pair counts in the first block that it is under the budget in.
                for b in (block, *range(block)):
                    if len(i):
                        keep = (_apart(y, i, j, b) <= budget) == (b == block)
                        i, j = i[keep], j[keep]
                ok = (x[i] * x[j]).sum(1) >= cosine
                i, j = i[ok], j[ok]
                np.add.at(n_links, i, weight[j])
                np.add.at(n_links, j, weight[i])
                root = _roots(root, root[i], root[j])
        out = np.flatnonzero(n_links)
        return pa.table({"id": pa.array(ids[out]), "n": pa.array(n_links[out]), "root": pa.array(ids[root[out]])})
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """`vectors` has vec_id, embedding, label. Returns (vec_id, n_links,
    component_id, kept): n_links counts the other vectors of the same label
    with at least this cosine, component_id is the least vec_id that links
    lead to, kept marks vec_id = component_id (a null vec_id is kept)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(in_arrow(rows, _read, "vec_id long, label string, dims int, vector binary"), "vectors")
    linkable = rows.filter("vector is not null and vec_id is not null")
    # Equal vectors are one from here on.
    classes = stored(linkable.groupBy("label", "dims", "vector")
                     .agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")), "vector-classes")
    ship_package(vectors.sparkSession)
    cells = in_arrow(classes.select("id", "label", "vector", "weight", "dims"), _cells(cosine),
                     "id long, label string, cell string, block int, home boolean, weight long, vector binary, dims int")
    tiles = stored(cells.groupBy("label", "cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")),
                   "vector-tiles")
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    own = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    places = F.concat(
        F.transform(every, lambda k: F.struct(k.alias("i"), own.alias("j"), F.lit(False).alias("lead"))),
        F.when(F.col("home"), F.transform(every, lambda k: F.struct(own.alias("i"), k.alias("j"),
                                                                   F.lit(True).alias("lead"))))
        .otherwise(F.array().cast("array<struct<i:int,j:int,lead:boolean>>")))
    dealt = (cells.join(tiles, ["label", "cell"]).withColumn("at", F.explode(places))
             .select("label", "cell", F.col("at.i").alias("i"), F.col("at.j").alias("j"),
                     F.col("at.lead").alias("lead"), "id", "block", "weight", "vector", "dims"))
    found = stored(dealt.groupBy("label", "cell", "i", "j").applyInArrow(_join(cosine), "id long, n long, root long"),
                   "vector-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_class = (classes.join(counts, "id", "left").join(labels, "id", "left")
                 .select("label", "dims", "vector", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                         F.coalesce("component_id", "id").alias("component_id")))
    joined = linkable.join(per_class, ["label", "dims", "vector"]).select("vec_id", "n_links", "component_id")
    rest = rows.filter("vector is null or vec_id is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(rest).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
