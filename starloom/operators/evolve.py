"""Merging a history into a newer schema.

Over the years staged columns get wider types and new tracked columns appear. A
history of the older schema is first brought to the newer one, by these rules:

* a type may only widen (whole numbers, float to double, decimals that keep all
  digits on both sides of the point, dates to timestamps): values, and with them the
  fingerprints of unchanged rows, are compared in the wider type. A narrowing or
  unrelated type is an error that names the column;
* an added column is NULL in the rows of the older schema. Under ``added="compare"``
  NULL is a value like any other, so a key whose new column is filled gets a new
  version; under ``added="fill"`` the fingerprint of such a row leaves the added
  columns out, and a key that is otherwise unchanged keeps its version and takes the
  present values;
* a column that the newer schema no longer has is an error: dropping history is a
  decision for the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import conf
from starloom.operators.scd2 import scd2_merge

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
ADDED = ("compare", "fill")


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type is one of the new."""
    if old == new:
        return True
    if isinstance(old, _WHOLE) and isinstance(new, _WHOLE):
        return _WHOLE.index(type(old)) < _WHOLE.index(type(new))
    if isinstance(old, _WHOLE) and isinstance(new, T.DecimalType):
        return new.precision - new.scale >= _DIGITS[type(old)]
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if isinstance(old, T.DateType):
        return isinstance(new, (T.TimestampType, T.TimestampNTZType))
    # Whole numbers of 32 bits and single precision are exact in double precision.
    return isinstance(new, T.DoubleType) and isinstance(old, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))


def conform_history(history: DataFrame, current: DataFrame) -> tuple[DataFrame, list[str]]:
    """The history with the columns and types of ``current`` (and its SCD2 columns),
    and the columns that it did not have."""
    gone = [c for c in history.columns if c not in current.columns and c not in conf.SCD2_COLUMNS]
    if gone:
        raise ValueError(f"the newer schema lacks columns of the history: {gone}")
    columns, added = [], []
    for field in current.schema.fields:
        if field.name not in history.columns:
            added.append(field.name)
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        old = history.schema[field.name].dataType
        if not widens(old, field.dataType):
            raise ValueError(f"column {field.name!r} narrows from {old.simpleString()} to {field.dataType.simpleString()}")
        columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return history.select(*columns, *conf.SCD2_COLUMNS), added


def scd2_merge_evolved(history: DataFrame, current: DataFrame, key: str, tracked: Sequence[str], load_date,
                       added: str = "compare", max_sk: int | None = None) -> DataFrame:
    """SCD2 merge of a history of an older schema with staged rows of a newer one."""
    if added not in ADDED:
        raise ValueError(f"added must be one of {ADDED}, not {added!r}")
    history, new = conform_history(history, current)
    if added == "compare" or not new:
        return scd2_merge(history, current, key, tracked, load_date, max_sk=max_sk)
    old_tracked = [c for c in tracked if c not in new]
    merged = scd2_merge(history, current, key, old_tracked, load_date, max_sk=max_sk, with_action=True)
    values = current.select(F.col(key).alias("_key"), F.struct(*new).alias("_new"))
    same = merged.filter(F.col("action") == F.lit(conf.NOCHANGE))
    rest = merged.filter(~F.coalesce(F.col("action") == F.lit(conf.NOCHANGE), F.lit(False)))
    filled = same.join(values, F.col(key).eqNullSafe(F.col("_key")), "left").withColumns(
        {c: F.col(f"_new.{c}") for c in new})
    return rest.drop("action").unionByName(filled.select(*rest.drop("action").columns))
