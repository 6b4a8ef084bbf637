"""Importance resampling towards a target distribution.

A document's features are its runs of 1 to `longest` consecutive words, hashed to
`buckets` buckets. A bucket's gain is the logarithm of how much likelier it is in
the target's texts than in all documents; a document's weight is the sum of the
gains of its features, and adding Gumbel noise to it and keeping the highest
scores draws documents without replacement, in proportion to exp(weight / 1000).

Texts are taken apart by Arrow kernels: ascii_lower, split_pattern_regex,
list_flatten and dictionary_encode give each slice of texts its distinct words and
an index for every word. Shifted indices form the longer runs: a run is a pair
(run that is one word shorter, next word), distinct pairs are found once, and the
CRC of a pair goes on from the CRC of its first part. Gains are taken by bucket and
summed by segment.

Spark counts buckets over all documents and all target texts (each task sends at
most `buckets` rows), and ranks the drawn documents by ranges of the score, so
neither a task nor the driver holds more than one range or one row for each bucket
or range.

Null texts have no words. Repeated rows count and are drawn each for itself; ties
of score go to the lesser doc_id, a null one last, then to any. A null doc_id is
the empty string where the noise is hashed. Extra columns are left out. No target
text, or no documents, is no special case: all counts are 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, in_arrow, stored

#: Fixed value: what separates words, after A-Z became a-z.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that the kernels work on at once (a longer text is one step).
STEP = 4 << 20


def steps(column: pa.Array, limit: int = STEP) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) for runs of whole texts of about `limit` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(column):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield lo, column.slice(lo, hi - lo)
        lo = hi


def words_of(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the index of every word in order, and its text."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), BREAKS)
    coded = pc.dictionary_encode(pc.list_flatten(lists))
    owner = pc.list_parent_indices(lists).to_numpy()
    index = coded.indices.to_numpy()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    if b"" in words:  # what stands before a first or behind a last break
        full = index != words.index(b"")
        index, owner = index[full], owner[full]
    return words, index.astype(np.int64), owner.astype(np.int64)


def feature_buckets(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket and the text of every feature, and each text's number of words."""
    words, index, owner = words_of(texts)
    n_words = np.bincount(owner, minlength=len(texts))
    # CRC of every distinct run, and of every word with the space before it.
    crc = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words))
    run, at = index, np.arange(len(index))
    out, owners = [crc[run] % buckets], [owner]
    for size in range(2, longest + 1):
        inside = at + size - 1 < len(index)
        run, at = run[inside], at[inside]
        inside = owner[at] == owner[at + size - 1]
        run, at = run[inside], at[inside]
        pairs, run = np.unique(run * len(words) + index[at + size - 1], return_inverse=True)
        head, tail = np.divmod(pairs, max(len(words), 1))
        crc = np.fromiter((zlib.crc32(b" " + words[w], int(c)) for c, w in zip(crc[head], tail.tolist())),
                          np.int64, len(pairs))
        out.append(crc[run] % buckets)
        owners.append(owner[at])
    return np.concatenate(out), np.concatenate(owners), n_words


def _counts(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in steps(batch.column(0)):
                total += np.bincount(feature_buckets(texts, longest, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bucket", "n"])
    return run


def bucket_gains(docs: DataFrame, target: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """The gain of every bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))."""
    def counts(table: DataFrame) -> DataFrame:
        return (in_arrow(table.select(F.col("text").cast("string").alias("text")), _counts(longest, buckets),
                         "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")))
    s, t = np.zeros(buckets), np.zeros(buckets)
    for column, table in ((s, docs), (t, target)):
        for row in counts(table).collect():  # one row for each bucket at most
            column[row.bucket] = row.n
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(gains: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            features, words, weight = (np.zeros(n, np.int64) for _ in range(3))
            for lo, texts in steps(batch.column(1)):
                bucket, owner, n_words = feature_buckets(texts, longest, len(gains))
                hi = lo + len(texts)
                words[lo:hi] = n_words
                features[lo:hi] = np.bincount(owner, minlength=len(texts))
                # Sums by segment: runs of one text are neighbours, sizes one after another.
                edge = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
                np.add.at(weight, lo + owner[edge], np.add.reduceat(gains[bucket], edge) if len(edge) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(features), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"])
    return run


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10000, percent: int = 10,
             least_words: int = 20, seed: int = 2024) -> DataFrame:
    """`docs` has doc_id and text, `target` text. Returns (doc_id, n_features,
    weight, score, rank) of every row: rank is 1, 2, ... in descending order of
    score for the floor(percent * N / 100) highest of the N rows of `least_words`
    words or more, null for the others."""
    gains = bucket_gains(docs, target, longest, buckets)
    weighed = in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                       _weights(gains, longest), "doc_id long, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = stored(weighed.withColumn("score", (F.col("weight") + noise).cast("long")), "scores")
    # Ranges of the score, each with its number; equal rows may fall into several.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("place").asc()]
    ranged = stored(scored.filter(F.col("n_words") >= least_words).withColumn("place", F.monotonically_increasing_id())
                    .repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "score-ranges")
    counts = sorted((r.part, r["count"]) for r in ranged.groupBy("part").count().collect())
    drawn = percent * sum(n for _, n in counts) // 100
    before, total = [], 0
    for part, n in counts:
        before.append((part, total))
        total += n
    offsets = docs.sparkSession.createDataFrame(before, "part int, before long")
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ranked = (ranged.join(F.broadcast(offsets), "part")  # one row for each range
              .withColumn("place", place).withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))))
    columns = ["doc_id", "n_features", "weight", "score"]
    out = stored(ranked.select(*columns, "rank").unionByName(
        scored.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))), "drawn")
    forget(scored, ranged)
    return out
