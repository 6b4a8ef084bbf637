"""Surrogate keys: dense integers in natural-key order, optionally continuing
after the current maximum.

Rows are cut into ordered key ranges of about ``starloom.keys.rowsPerRange``
rows and numbered in parallel:

1. the keys alone are stored, so that what follows reads them and not the plan above;
2. quantiles of the key give range boundaries (one pass, bounded memory);
3. each row gets its range index (``Bucketizer``: binary search, JVM side);
4. rows are counted per (segment, range): a table of at most
   segments x ranges rows, turned into running offsets on the driver;
5. ``row_number()`` within each range plus that range's offset.

An input of one range has one offset, the start: it needs neither boundaries nor counts.

Boundaries and offsets are literals in the final plan, so a recomputed task
(lost executor) produces the same keys. Key types without a numeric order
(strings, ...) use range partitioning instead, after a reliable checkpoint
fixes which rows fall in which partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import conf
from starloom.operators.cdc import max_value
from starloom.session import materialize


def max_surrogate_key(df: DataFrame, col: str = conf.SK_COL) -> int:
    """Current max key, 0 for an empty table (never None)."""
    value = max_value(df, col)
    return 0 if value is None else int(value)


def _order(order_col: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(order_col).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in tiebreak]


def _numeric_proxy(c: Column, dtype: T.DataType) -> Column | None:
    """A double that is non-decreasing in the column's order, or None."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                          T.FloatType, T.DoubleType, T.DecimalType)):
        return c.cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    return None


def assign_surrogate_keys(df: DataFrame, order_col: str, out_col: str = conf.SK_COL,
                          start: int = 0, segment_col: str | None = None,
                          tiebreak: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Add ``out_col`` = start + 1, start + 2, ... in order of
    (``segment_col``, ``order_col`` NULLS FIRST, ``tiebreak``).

    ``segment_col`` (small integers) numbers whole segments one after the
    other, e.g. inserts before updates. ``order_col`` should be unique within a
    segment (or made so with ``tiebreak``) for the numbering to be repeatable.
    ``rows``, when the caller knows it, is the row count or an upper bound of
    it (saves a counting job).
    """
    spark = df.sparkSession
    n = df.count() if rows is None else rows
    n_ranges = max(1, math.ceil(n / conf.tunable(spark, conf.SK_ROWS_PER_RANGE)))
    if n_ranges == 1:
        first = [F.col(segment_col).asc()] if segment_col else []
        whole = Window.partitionBy(F.lit(0)).orderBy(*first, *_order(order_col, tiebreak))
        return df.select("*", (F.lit(start) + F.row_number().over(whole)).cast("long").alias(out_col))
    proxy = _numeric_proxy(F.col(order_col), df.schema[order_col].dataType)
    if proxy is not None:
        return _keys_by_quantile_ranges(df, order_col, out_col, start, segment_col, tiebreak,
                                        proxy, n_ranges)
    return _keys_by_range_partitions(df, order_col, out_col, start, segment_col, tiebreak, n_ranges)


def _running_offsets(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """[(segment, range, rows)] -> [(segment, range, rows before it)]."""
    out, total = [], 0
    for seg, rng, rows in sorted(counts):
        out.append((seg, rng, total))
        total += rows
    return out


def _keys_by_quantile_ranges(df, order_col, out_col, start, segment_col, tiebreak, proxy,
                             n_ranges) -> DataFrame:
    from pyspark.ml.feature import Bucketizer

    spark = df.sparkSession
    seg = (F.col(segment_col) if segment_col else F.lit(0)).cast("int")
    keys = materialize(df.select(proxy.alias("_k"), seg.alias("_seg")))
    probs = [i / n_ranges for i in range(1, n_ranges)]
    # The error stays below a quarter of a range, however many there are.
    cuts = keys.filter(F.col("_k").isNotNull()).approxQuantile("_k", probs, 1 / (4 * n_ranges))
    splits = [-math.inf] + sorted(set(cuts)) + [math.inf]

    def with_range(rows: DataFrame) -> DataFrame:
        if len(splits) == 2:
            rows = rows.withColumn("_range", F.lit(0))
        else:
            rows = Bucketizer(splits=splits, inputCol="_k", outputCol="_range", handleInvalid="keep").transform(rows)
        return rows.withColumn("_range", F.when(F.col("_k").isNull(), F.lit(-1)).otherwise(F.col("_range").cast("int")))
    ranged = with_range(df.withColumns({"_k": proxy, "_seg": seg}))
    # segments x ranges rows at most: a bounded driver round trip.
    counts = [(r["_seg"], r["_range"], r["count"])
              for r in with_range(keys).groupBy("_seg", "_range").count().collect()]
    offsets = spark.createDataFrame(_running_offsets(counts),
                                    "_seg int, _range int, _offset long")
    w = Window.partitionBy("_seg", "_range").orderBy(*_order(order_col, tiebreak))
    return (ranged.join(F.broadcast(offsets), ["_seg", "_range"], "inner")
                  .withColumn(out_col, (F.lit(start) + F.col("_offset") + F.row_number().over(w))
                              .cast("long"))
                  .select(*df.columns, out_col))


def _keys_by_range_partitions(df, order_col, out_col, start, segment_col, tiebreak,
                              n_ranges) -> DataFrame:
    spark = df.sparkSession
    seg = (F.col(segment_col) if segment_col else F.lit(0)).cast("int").alias("_seg")
    order = [F.col("_seg").asc()] + _order(order_col, tiebreak)
    ranged = (df.select("*", seg).repartitionByRange(n_ranges, *order)
                .sortWithinPartitions(*order))
    # Range bounds are sampled per execution: fix the partitions once.
    ranged = materialize(ranged)
    counts = [(0, r["_part"], r["count"]) for r in
              ranged.groupBy(F.spark_partition_id().alias("_part")).count().collect()]
    offsets = spark.createDataFrame([(p, off) for _, p, off in _running_offsets(counts)],
                                    "_part int, _offset long")
    positioned = (ranged.withColumn("_part", F.spark_partition_id())
                        .withColumn("_pos", F.monotonically_increasing_id()))
    local = F.col("_pos") - F.shiftleft(F.col("_part").cast("long"), 33)
    return (positioned.join(F.broadcast(offsets), "_part", "inner")
                      .withColumn(out_col, (F.lit(start) + F.col("_offset") + local + 1).cast("long"))
                      .select(*df.columns, out_col))
