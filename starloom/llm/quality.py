"""Quality classifier by positive-unlabelled learning.

A text becomes FEATURES counts and ratios (byte classes, word shapes,
repetition of words, word pairs and lines), each cut into BINS quantile bins
over all texts; the score is a logistic function of one weight for each bin.

The weights minimise the non-negative unbiased risk: trusted positives P and
unlabelled text U give the risk of the positives, and that of the negatives as
risk(U) - prior * risk(P), which counts only while it is not below zero. The
loss of a score z is the bounded 1 / (1 + exp(z)); an unbounded one could make
the negatives' risk arbitrarily low by the positives' part alone. Both
means are taken over all rows in Spark, once for each L-BFGS step; only sums
reach the driver. The class prior is estimated first: a classifier of P against
U, learned on one half of the rows, ranks those of the other half, and the
prior is the least ratio of U's to P's share above any score, each with one
standard error added (where no negatives are left, that ratio is the prior).

Null and empty texts have all counts zero and get a score like others. Labels
that are null teach nothing; several labels of a document count each. Without
trusted positives or unlabelled rows every score is the prior 0.5. Repeated
rows count each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, shingle_hashes, sorted_sets, span_hashes, stored, text_slices, word_spans

BINS = 12
STEPS = 30
RIDGE = 1e-4
#: The prior is read where at least this share of P lies above the score.
LEAST_TAIL = 0.1
#: Width of the round corner that the non-negative risk has at zero.
ROUNDING = 0.01

# Byte classes: 0 other, then those below, in this order.
_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".", b",",
            b"!?", b"|", b"#$%&*@^~", b"'\"()[]{}<>", b"-_=+/\\:;")
_CLASS = np.zeros(256, np.int64)
for _i, _c in enumerate(_CLASSES):
    _CLASS[list(_c)] = _i + 1
_CLASS[128:] = len(_CLASSES) + 1
_KINDS = len(_CLASSES) + 2
_LINE = np.zeros(256, bool)
_LINE[10] = True
_SENTENCE = np.zeros(256, bool)
_SENTENCE[list(b".!?")] = True
NAMES = (*(f"class{i}" for i in range(_KINDS)), "bytes", "words", "word_size", "word_spread", "distinct_words",
         "top_word", "same_as_before", "distinct_pairs", "lines", "distinct_lines", "sentence_ends", "capitals")


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each owner, and the count of its most frequent one."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]) if len(
        hashes) else np.zeros(0, int)
    top = np.zeros(n)
    np.maximum.at(top, owner[first], np.diff(np.r_[first, len(hashes)]))
    return np.bincount(owner[first], minlength=n), top


def features(column: pa.Array) -> np.ndarray:
    """One row of numbers for each text."""
    out = []
    for lo, hi, data, at in text_slices(column):
        n = hi - lo
        size = np.diff(at)
        doc = np.repeat(np.arange(n), size)
        share = np.bincount(doc * _KINDS + _CLASS[data], minlength=n * _KINDS).reshape(n, _KINDS) / np.maximum(
            size, 1)[:, None]
        start, end, owner = word_spans(data, at)
        width = end - start
        words = np.bincount(owner, minlength=n)
        some = np.maximum(words, 1)
        mean = np.bincount(owner, width, n) / some
        spread = np.sqrt(np.maximum(np.bincount(owner, width.astype(float) ** 2, n) / some - mean ** 2, 0))
        hashes = span_hashes(data, start, end)
        kinds, top = _distinct(hashes, owner, n)
        again = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
        pairs, pair_owner = shingle_hashes(hashes, owner, 2)
        pair_kinds = np.bincount(sorted_sets(pairs, pair_owner)[1], minlength=n)
        a, b, line_owner = word_spans(data, at, _LINE)
        lines = np.bincount(line_owner, minlength=n)
        line_kinds = np.bincount(sorted_sets(span_hashes(data, a, b), line_owner)[1], minlength=n)
        ends = np.bincount(owner, _SENTENCE[data[end - 1]], n)
        capitals = np.bincount(owner, _CLASS[data[start]] == 2, n)
        out.append(np.c_[share, np.log1p(size), np.log1p(words), mean, spread, kinds / some ** 0.85, top / some,
                         again / some, pair_kinds / some, np.log1p(lines), line_kinds / np.maximum(lines, 1),
                         ends / some, capitals / some])
    return np.concatenate(out) if out else np.zeros((0, len(NAMES)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(batch.column(batch.num_columns - 1)).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *(pa.array(np.ascontiguousarray(x[:, k])) for k in range(x.shape[1]))],
            [*batch.schema.names[:-1], *NAMES])


def _codes(batch: pa.RecordBatch, edges: list[np.ndarray]) -> np.ndarray:
    """Places in the weight vector, one for each feature of each row; the
    features are the last columns."""
    skip = batch.num_columns - len(NAMES)
    return np.stack([np.searchsorted(edges[k], batch.column(skip + k).to_numpy(zero_copy_only=False), "right")
                     + k * BINS for k in range(len(NAMES))], 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _sums(weights: np.ndarray, edges: list[np.ndarray], bounded: bool):
    """For the rows of each task, by kind (0 unlabelled, 1 positive): count,
    loss as a positive and as a negative, and their gradients."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(NAMES) * BINS
        total = np.zeros((2, 3 + 2 * size))
        for batch in batches:
            code = _codes(batch, edges)
            positive = batch.column(0).to_numpy(zero_copy_only=False)
            z = weights[code].sum(1) + weights[-1]
            up = _sigmoid(z)
            losses = (1 - up, up) if bounded else (np.logaddexp(0, -z), np.logaddexp(0, z))
            slopes = (up * (up - 1), up * (1 - up)) if bounded else (up - 1, up)
            for kind in (0, 1):
                of = positive == kind
                if of.any():
                    flat = code[of].ravel()
                    total[kind, 0] += of.sum()
                    total[kind, 1:3] += losses[0][of].sum(), losses[1][of].sum()
                    total[kind, 3:3 + size] += np.bincount(flat, np.repeat(slopes[0][of], len(NAMES)), size)
                    total[kind, 3 + size:] += np.bincount(flat, np.repeat(slopes[1][of], len(NAMES)), size)
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["k", "v"])
    return run


def _minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int) -> np.ndarray:
    """L-BFGS with halved steps; at most `steps` evaluations of f."""
    value, slope = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    length, used = 1.0, 1
    while used < steps and np.abs(slope).max() > 1e-5:
        way = -slope
        held = []
        for s, y in reversed(past[-8:]):
            a = s @ way / (s @ y)
            way = way - a * y
            held.append(a)
        if past:
            way = way * (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        for (s, y), a in zip(past[-8:], reversed(held)):
            way = way + s * (a - y @ way / (s @ y))
        length = 1.0 if past else min(1.0, 1 / np.abs(slope).sum())
        while used < steps:
            new, new_slope = f(x + length * way)
            used += 1
            if new <= value + 1e-4 * length * (slope @ way):
                break
            length /= 2
        else:
            break
        if (new_slope - slope) @ way > 1e-12:
            past.append((length * way, new_slope - slope))
        x, value, slope = x + length * way, new, new_slope
    return x


def _train(rows: DataFrame, edges: list[np.ndarray], risk: Callable, bounded: bool,
           start: np.ndarray | None = None) -> np.ndarray:
    size = len(NAMES) * BINS

    def f(weights):
        got = (in_arrow(rows, _sums(weights, edges, bounded), "k int, v double").groupBy("k")
               .agg(F.sum("v").alias("v")).toArrow())  # one row for each sum
        flat = np.zeros(2 * (3 + 2 * size))
        flat[got["k"].to_numpy()] = got["v"].to_numpy()
        unlabelled, positive = flat.reshape(2, -1)
        mean = lambda t: (t[1] / t[0], t[2] / t[0], t[3:3 + size] / t[0], t[3 + size:] / t[0])
        value, slope = risk(mean(unlabelled), mean(positive))
        # Each row has one bin of each feature: the intercept's slope is that of any one feature.
        slope = np.r_[slope, slope[:BINS].sum()]
        return value + RIDGE / 2 * weights[:-1] @ weights[:-1], slope + RIDGE * np.r_[weights[:-1], 0]

    return _minimise(f, np.zeros(size + 1) if start is None else start, STEPS)


def _apart(u, p):
    """Risk of telling P from U, each weighing one half."""
    return (u[1] + p[0]) / 2, (u[3] + p[2]) / 2


def non_negative_risk(prior: float) -> Callable:
    """prior * risk(P) + max(0, negatives' risk), the maximum rounded off so
    that its slope is continuous."""
    def risk(u, p):
        negative, slope = u[1] - prior * p[1], u[3] - prior * p[3]
        held = _sigmoid(np.array(negative / ROUNDING))
        return prior * p[0] + ROUNDING * np.logaddexp(0, negative / ROUNDING), prior * p[2] + held * slope
    return risk


def _scores(weights: np.ndarray, edges: list[np.ndarray], keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _sigmoid(weights[_codes(batch, edges)].sum(1) + weights[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], pa.array(score)],
                                             [*batch.schema.names[:keep], "score"])
    return run


def class_prior(scored: DataFrame) -> float:
    """From (positive, score): the least ratio of U's to P's share above a score."""
    cells = (scored.groupBy(F.least(F.floor(F.col("score") * 1000), F.lit(999)).cast("int").alias("cell"), "positive")
             .count().collect())  # at most 2000 rows
    table = np.zeros((2, 1000))
    for r in cells:
        table[r["positive"], r["cell"]] = r["count"]
    above = table[:, ::-1].cumsum(1) / table.sum(1, keepdims=True)
    enough = above[1] >= LEAST_TAIL
    u, p = above[0][enough], above[1][enough]
    error = sum((1 - x) / np.maximum(x * n, 1) for x, n in ((u, table[0].sum()), (p, table[1].sum())))
    return float(np.clip((u / p * (1 + np.sqrt(error))).min(), 0.01, 0.99))


def score_quality(docs: DataFrame, positives: DataFrame, taught: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` (doc_id among them) with the score of its text.
    `positives` (doc_id) are the trusted positives, `taught` (doc_id) all rows
    with a label to learn from: the other documents are the unlabelled ones."""
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    table = stored(in_arrow(rows, _features, f"{kept}, " + ", ".join(f"{n} float" for n in NAMES)), "quality-features")
    marks = (taught.select("doc_id").withColumn("positive", F.lit(-1))
             .unionByName(positives.select("doc_id").withColumn("positive", F.lit(1)))
             .groupBy("doc_id").agg(F.max("positive").alias("positive")))
    numbers = table.select("doc_id", *NAMES).join(marks, "doc_id", "left")
    training = stored(numbers.select(F.coalesce("positive", F.lit(0)).alias("positive"),
                                     (F.xxhash64("doc_id") % 2 == 0).alias("half"), *NAMES)
                      .filter("positive >= 0"), "quality-training")
    first, other = (training.filter("half" if h else "not half").drop("half") for h in (True, False))
    at = [k / BINS for k in range(1, BINS)]
    cuts = table.approxQuantile(list(NAMES), at, 0.005)
    edges = [np.unique(np.array(c, np.float32)) for c in cuts]
    if training.groupBy("half", "positive").count().count() < 4:  # too few rows for two halves of both kinds
        return table.select(*keep).withColumn("score", F.lit(0.5))
    apart = _train(first, edges, _apart, False)
    prior = class_prior(in_arrow(other, _scores(apart, edges, 1), "positive int, score double"))
    # The first classifier's score is the log of the ratio of P's to U's density:
    # prior * exp(score) = 1 / 2 is the border to start from.
    start = np.r_[apart[:-1], apart[-1] + np.log(2 * prior)]
    weights = _train(training.drop("half"), edges, non_negative_risk(prior), True, start)
    return in_arrow(table.select(*keep, *NAMES), _scores(weights, edges, len(keep)), f"{kept}, score double")
