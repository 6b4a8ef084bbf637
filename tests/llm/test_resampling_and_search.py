"""Importance resampling, centroid clustering and tree search against brute force."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import centroid_clusters, importance_resampling, kmeans_tree_search
from starloom.llm.kmeans_tree import Tree
from starloom.llm.queries import QUERIES
from starloom.llm.vectors import packed, read_vectors, unpacked

pytestmark = pytest.mark.slow


# -- importance resampling --------------------------------------------------------

def features_of(text, longest):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def resampled(docs, target, longest, buckets, percent, least, seed):
    def counts(texts):
        out = [0] * buckets
        for text in texts:
            for run in features_of(text, longest)[1]:
                out[zlib.crc32(run.encode()) % buckets] += 1
        return out
    s, t = counts(text for _, text in docs), counts(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets))))
            for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        n, runs = features_of(text, longest)
        weight = sum(gain[zlib.crc32(r.encode()) % buckets] for r in runs)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((n, (doc_id, len(runs), weight, score)))
    rows.sort(key=lambda r: (-r[1][3], r[1][0] is None, r[1][0] or 0))
    drawn, out = percent * sum(n >= least for n, _ in rows) // 100, []
    for n, row in rows:
        place = 1 + sum(r[-1] is not None for r in out)
        out.append((*row, place if n >= least and place <= drawn else None))
    return out


def same(got, want):
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_on_odd_rows(spark, odd_docs, no_docs, longest):
    target = [(1, "W1 w2 x1, the words"), (2, None), (3, "")]
    table = spark.createDataFrame(target, "item_id long, text string").withColumn("weight", F.lit("x"))
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = importance_resampling.resample(odd_docs, table, longest, 97, 50, 5)
    same(got.collect(), resampled(docs, [t for _, t in target], longest, 97, 50, 5, 2024))
    none = importance_resampling.resample(odd_docs, table.limit(0), longest, 97, 50, 5)
    same(none.collect(), resampled(docs, [], longest, 97, 50, 5, 2024))
    assert importance_resampling.resample(no_docs, table).count() == 0


def test_resampling_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    same(QUERIES["op11_arrow_importance_resampling"](spark, SF_SMALL).collect(),
         resampled(docs, target, 1, 10000, 10, 20, 2024))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ9é漢 ,\x00\x7f\n-", max_size=30)), max_size=8), st.integers(1, 4))
def test_feature_buckets(texts, longest):
    bucket, owner, n_words = importance_resampling.feature_buckets(pa.array(texts, pa.string()), longest, 1000)
    for i, text in enumerate(texts):
        n, runs = features_of(text, longest)
        assert n_words[i] == n
        assert sorted(bucket[owner == i].tolist()) == sorted(zlib.crc32(r.encode()) % 1000 for r in runs)


def test_steps_cover_all_texts():
    texts = pa.array(["a" * n for n in (0, 5, 100, 3, 3, 0, 50)])
    parts = list(importance_resampling.steps(texts, 10))
    assert [t for _, part in parts for t in part.to_pylist()] == texts.to_pylist()
    assert [lo for lo, _ in parts] == [0, 2, 3, 6]


# -- vectors ------------------------------------------------------------------------

def odd_vectors(spark, size, n, seed=1):
    """Normal vectors with copies, ties, repeated rows, nulls, other lengths, and
    extra columns with the operators' own names."""
    x = np.random.default_rng(seed).standard_normal((n, size)).astype("f4").astype(float)
    x[5:9] = x[4]
    x[10] = np.round(x[10])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (3, rows[7][1]), (None, rows[2][1]), (900, None), (901, []),
             (902, [0.0] * size), (903, [float("nan")] * size), (904, [float("inf")] + [1.0] * (size - 1)),
             (905, [None] + [1.0] * (size - 1)), (906, [1.0] * (size + 1)), (1000, [0.1] * (size + 1)),
             (907, [0.1] * size), (908, [-0.0] * (size - 1) + [0.1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return rows, table.withColumns({"cluster": F.lit("x"), "cls": F.lit(1), "leaf": F.lit("l"), "part": F.lit(0),
                                    "distance": F.lit(1.5)}).repartition(3)


def test_vector_reader():
    column = pa.array([[1.0, 2.0], None, [], [None, 1.0], [float("nan")], [3.0]], pa.list_(pa.float64()))
    for part in (column, column.slice(1, 4), column.slice(5), column.slice(2, 0)):
        ok, size, values, first = read_vectors(part)
        want = [v is not None and all(c is not None and c == c for c in v) for v in part.to_pylist()]
        assert ok.tolist() == want
        assert size.tolist() == [len(v or []) for v in part.to_pylist()]
        for i, v in enumerate(part.to_pylist()):
            if want[i]:
                assert values[first[i]:first[i] + size[i]].tolist() == v
    x = np.arange(12, dtype="<i4").reshape(4, 3)
    assert (unpacked(packed(x).slice(1, 2), 3, "<i4") == x[1:3]).all()
    assert unpacked(packed(x[:0]), 3, "<i4").shape == (0, 3)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.integers(1, 6), st.integers(1, 9))
def test_threshold_algorithm(seed, k, size, spread):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-spread, spread + 1, (40, size)), rng.integers(-spread, spread + 1, (k, size))
    apart = ((x[:, None] - c) ** 2).sum(2)
    which, best = centroid_clusters.nearest(x, c)
    assert (which == apart.argmin(1)).all() and (best == apart.min(1)).all()


def clustered(rows, k, dims, rounds, scale, seed):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (key(r[0]), np.array(r[1], "<i4").tobytes()))[:k]]

    def assign():
        apart = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids] for _, v in kept]
        return [(min(range(len(d)), key=lambda j: (d[j], j)), min(d)) for d in apart]
    for _ in range(rounds):
        which = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (c, _) in zip(kept, which) if c == j]
            if own:
                centroids[j] = [sum(p) // len(own) for p in zip(*own)]
    which = assign()
    inertia = [sum(d for c, d in which if c == j) for j in range(len(centroids))]
    return [(i, c, d, inertia[c], sum(inertia), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for (i, _), (c, d) in zip(kept, which)]


@pytest.mark.parametrize("k", [3, 200])
def test_clusters_on_odd_rows(spark, k):
    rows, table = odd_vectors(spark, 6, 60)
    same(centroid_clusters.cluster(table, k, 6, 4).collect(), clustered(rows, k, 6, 4, 1024, 3))
    assert centroid_clusters.cluster(table, 3, 99).count() == 0
    assert centroid_clusters.cluster(table.limit(0)).columns == centroid_clusters.cluster(table, 3, 6, 1).columns


def test_components_too_large_for_exact_distances(spark):
    table = spark.createDataFrame([(1, [1e12, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="may not fit a long"):
        centroid_clusters.cluster(table, 1, 2)


# -- tree search ---------------------------------------------------------------------

def neighbours(rows, asks, k):
    """Per query row (id, vector) the k nearest other rows, rows of one id and
    vector taken as one."""
    full = {(i, tuple(v)) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v)
            and any(v)}
    out = []
    for i, v in full:
        if asks(i):
            q = np.array(v)
            near = sorted((float(np.sqrt(((np.array(w) - q) ** 2).sum())), j) for j, w in full
                          if len(w) == len(v) and (j, w) != (i, v))
            out += [(i, rank + 1, j, d) for rank, (d, j) in enumerate(near[:k])]
    return out


def test_search_on_odd_rows(spark):
    rows, table = odd_vectors(spark, 6, 60)
    got = kmeans_tree_search.search(table, F.col("vec_id") % 3 == 0, 4).collect()
    same(got, neighbours(rows, lambda i: i % 3 == 0, 4))
    wide = kmeans_tree_search.search(table, F.col("vec_id") == 7, 500).collect()
    same(wide, neighbours(rows, lambda i: i == 7, 500))
    assert kmeans_tree_search.search(table, F.col("vec_id") == -1).count() == 0
    assert kmeans_tree_search.search(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_search_with_many_tiles(spark, monkeypatch):
    """A third of the rows share one vector; groups, tiles and leaves are small."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.standard_normal((400, 4)), np.ones((200, 4))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    for name, value in (("TILE", 40), ("ASKED", 7), ("SAMPLE", 100), ("GOAL", 1.0), ("CALIBRATION", 30)):
        monkeypatch.setattr(kmeans_tree_search, name, value)
    monkeypatch.setattr("starloom.llm.kmeans_tree.LEAF", 8)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in kmeans_tree_search.search(table, F.col("vec_id") % 5 == 0, 6).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    found = total = 0
    want = {}
    for i, rank, j, d in neighbours(rows, lambda i: i % 5 == 0, 6):
        want.setdefault(i, []).append((rank, j, d))
    assert set(got) == set(want) and all(len(v) == 6 for v in got.values())
    for i in want:
        found += len({j for _, j, _ in want[i]} & {j for _, j, _ in got[i]})
        total += 6
        for rank, j, d in got[i]:
            assert d == float(np.sqrt(((x[j] - x[i]) ** 2).sum()))
        assert [r for r, _, _ in sorted(got[i])] == [1, 2, 3, 4, 5, 6]
        assert [(d, j) for _, j, d in sorted(got[i])] == sorted((d, j) for _, j, d in got[i])
    assert found / total >= 0.95
    assert all(sorted(got[i]) == sorted(want[i]) for i in want if i >= 400)


def test_search_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    want = {(i, j): d for i, _, j, d in neighbours(rows, lambda i: i % 100 == 0, 10)}
    got = {(r.query_id, r.vec_id): r.score for r in QUERIES["op13_kmeans_tree_neighbours"](spark, SF_SMALL).collect()}
    assert len(got) == len(want) and len(set(got) & set(want)) / len(want) >= 0.9
    assert all(got[p] == pytest.approx(want[p], rel=1e-14) for p in set(got) & set(want))


def test_tree_traversal():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((700, 5))
    tree = Tree(x, 5)
    leaf = tree.place(x)
    held = np.bincount(leaf, minlength=tree.n_leaves)
    paths = tree.order(x[:50], tree.n_leaves, 0, held)
    assert all(sorted(p) == list(range(tree.n_leaves)) for p in paths)
    assert [p[0] for p in paths] == leaf[:50].tolist()
    assert all(held[p].sum() >= 300 for p in tree.order(x[:50], 1, 300, held))
    assert Tree(x[:0], 5).place(x).tolist() == [0] * 700
