"""Distinct values kept by counts.

A table of the distinct values of a column (cards in use, order statuses) is stored with
the number of rows that hold each value. A day's changes add the values that rows hold
now and take away those that they held before, so a value leaves exactly when its last
row does, and the large table itself is not read. NULL is one value.

Changes combine map-side before their shuffle, so a value that most rows hold is no
hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUPPORT = "support"


def support_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, support): how many rows hold each value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(SUPPORT))


def change_support(counts: DataFrame, held: DataFrame, hold: DataFrame, column: str) -> DataFrame:
    """Counts after a change. ``held`` are the changed rows as they were, ``hold`` as
    they are (rows that count only: live, and not null where null is no value). A
    count below zero means that ``held`` names rows that were never counted, and is
    an error when the result is read."""
    change = (held.groupBy(column).agg((-F.count(F.lit(1))).alias(SUPPORT))
              .unionByName(hold.groupBy(column).agg(F.count(F.lit(1)).alias(SUPPORT))))
    after = (counts.select(column, SUPPORT).unionByName(change)
             .groupBy(column).agg(F.sum(SUPPORT).alias(SUPPORT)))
    below = F.concat(F.lit("support below zero: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    checked = F.when(F.col(SUPPORT) < 0, F.raise_error(below).cast("long")).otherwise(F.col(SUPPORT))
    return after.withColumn(SUPPORT, checked).filter(F.col(SUPPORT) > 0)


def supported_values(counts: DataFrame, column: str) -> DataFrame:
    """The distinct values."""
    return counts.select(column)
