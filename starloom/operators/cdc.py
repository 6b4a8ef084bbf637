"""Change-tracked reads: soft-delete filter, watermark predicates, newest row
per key. All predicates are plain comparisons so they reach the parquet scan
(PushedFilters)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import conf


def live_rows(df: DataFrame, flag: str = conf.DELETED_FLAG) -> DataFrame:
    """Rows whose delete flag is false. A NULL flag is dropped too
    (three-valued comparison)."""
    return df.filter(F.col(flag) == F.lit(False))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
    return df


def after_watermark(df: DataFrame, ts_col: str, watermark, strict: bool = True) -> DataFrame:
    """Rows past the high watermark. ``strict`` is ``>`` (ties at the
    watermark are skipped); otherwise ``>=`` (ties re-read, harmless under a
    keyed merge). A None watermark means no previous load: every row passes."""
    if watermark is None:
        return df
    if isinstance(watermark, Column):
        wm = watermark
    elif isinstance(watermark, _dt.datetime) and isinstance(df.schema[ts_col].dataType,
                                                          T.TimestampNTZType):
        # A wall-clock literal: independent of the session and process time zones.
        wm = F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz")
    else:
        wm = F.lit(watermark)
    return df.filter(F.col(ts_col) > wm if strict else F.col(ts_col) >= wm)


def max_value(df: DataFrame, col: str):
    """Global max of one column as a Python value (one small job; partial
    aggregation per task, one row to the driver). None on empty input."""
    return df.agg(F.max(col).alias("m")).first()["m"]


def high_watermark(df: DataFrame, ts_col: str, flag: str | None = conf.DELETED_FLAG):
    """Max of ``ts_col`` over live rows (flag false), or all rows when
    ``flag`` is None."""
    if flag is not None and flag in df.columns:
        df = live_rows(df, flag)
    return max_value(df, ts_col)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def newest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols``; remaining
    columns break ties so the pick is deterministic.

    Written as an aggregate (``max`` of a row struct) rather than a ranking
    window so it combines map-side: a key holding a large share of the rows is
    reduced in every task before the shuffle instead of being sorted in one
    task."""
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    # One struct, ordering columns first: its max is the wanted row, and the
    # aggregation buffer (and the shuffle) carries each column once.
    row = F.struct(*[F.col(c) for c in list(order_cols) + rest])
    picked = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)

