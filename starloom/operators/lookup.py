"""Lookup joins: denormalizing parents into a driving table and resolving
natural keys to dimension surrogate keys.

Physical strategy. A lookup never loses a driving row (left join). By default
the join strategy is left to Spark: the planner broadcasts a side whose
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-plans from real shuffle sizes, splitting skewed partitions of the driving
side (a hot key, or the NULL keys of an optional reference, which all hash to
one partition). ``broadcast=True`` asks for a broadcast explicitly, but only
after checking the side's size against ``starloom.join.broadcastMaxBytes``
(its row count, known to the caller or from one counting job, times the
estimated width of a row) and the hash table that the driver builds of it against
the driver's heap; a larger side falls back to a shuffle join. Sides of one plan are
in the driver together, so :func:`checked_sides` counts them together.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import conf
from starloom.session import driver_heap, run_concurrently


def row_width(df: DataFrame) -> int:
    """Estimated bytes of a row: fixed widths, 64 for text and nested values."""
    wide = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    return 16 + sum(64 if isinstance(f.dataType, wide) else 8 for f in df.schema)


def relation_bytes(df: DataFrame, rows: int) -> tuple[int, int]:
    """Of the hash table that a broadcast is built as in the driver: its largest array, and
    the most it takes meanwhile. Slots of 16 bytes are at most half used, rows lie behind
    one another; both grow by doubling, the larger one beside its old half."""
    slots, page = (1 << max(0, n - 1).bit_length() for n in (32 * rows, row_width(df) * rows))
    return max(slots, page), slots + page + max(slots, page) // 2


def checked_sides(sides: Mapping[str, DataFrame], broadcast: bool | str = "auto",
                  known_rows: Mapping[str, int | None] | None = None) -> dict[str, DataFrame]:
    """The lookup sides of one plan (see :func:`checked_side`). Their hash tables are in the
    driver at the same time: a side, in the order given, is broadcast while those before it
    leave it room (``starloom.join.broadcastHeapShare`` of the heap). An array of more than a
    quarter of that room may find no free stretch of the heap, however much is free in all.
    The counting jobs of sides without ``known_rows`` run concurrently."""
    if broadcast is not True or not sides:
        return dict(sides)
    known = known_rows or {}
    rows = run_concurrently({n: (lambda n=n, s=side: s.count() if known.get(n) is None else known[n])
                             for n, side in sides.items()})
    spark = next(iter(sides.values())).sparkSession
    limit, heap = conf.tunable(spark, conf.BROADCAST_MAX_BYTES), driver_heap(spark)
    room = math.inf if heap is None else heap * conf.tunable(spark, conf.BROADCAST_HEAP_SHARE)
    checked, most = {}, room / 4
    for name, side in sides.items():
        array, need = relation_bytes(side, rows[name])
        fits = rows[name] * row_width(side) <= limit and need <= room and array <= most
        room -= need if fits else 0
        checked[name] = F.broadcast(side) if fits else side
    return checked


def _side(dim: DataFrame, broadcast: bool | str, known_rows: int | None = None) -> DataFrame:
    return checked_sides({"": dim}, broadcast, {"": known_rows})[""]


def lookup(df: DataFrame, dim: DataFrame, on: str | tuple[str, str],
           cols: Mapping[str, str] | Sequence[str], how: str = "left",
           broadcast: bool | str = "auto", null_safe: bool = False,
           known_rows: int | None = None) -> DataFrame:
    """Add ``cols`` of ``dim`` (``{output: dim_column}`` or names) to ``df``
    where ``df[left] == dim[right]``. The dimension is projected to the key
    and the requested columns before the join (column pruning reaches the
    scan)."""
    left, right = (on, on) if isinstance(on, str) else on
    mapping = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    rk = f"_lookup_{right}"
    side = dim.select(F.col(right).alias(rk), *[F.col(src).alias(out) for out, src in mapping.items()])
    side = _side(side, broadcast, known_rows)
    cond = df[left].eqNullSafe(side[rk]) if null_safe else df[left] == side[rk]
    return df.join(side, cond, how).drop(rk)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of one column (NULL is one value). Aggregates map-side
    first, so a hot value costs one row per task before the shuffle."""
    return df.select(key).distinct()


VERSIONS = ("current", "as_of", "all")
_RK, _EFF, _EXP = "_dim_key", "_dim_eff", "_dim_exp"


def dim_side(dim: DataFrame, dim_key: str, out_col: str, version: str = "current",
             sk_col: str = conf.SK_COL) -> DataFrame:
    """The part of a dimension a lookup needs: natural key, surrogate key
    (named ``out_col``) and, for ``as_of``, the validity interval."""
    if version not in VERSIONS:
        raise ValueError(f"unknown version {version!r}")
    if version == "current":
        dim = dim.filter(F.col(conf.CURRENT_COL) == F.lit(True))
    cols = [F.col(dim_key).alias(_RK), F.col(sk_col).alias(out_col)]
    if version == "as_of":
        cols += [F.col(conf.EFFECTIVE_COL).alias(_EFF), F.col(conf.EXPIRATION_COL).alias(_EXP)]
    return dim.select(*cols)


def checked_side(side: DataFrame, broadcast: bool | str = "auto",
                 known_rows: int | None = None) -> DataFrame:
    """Mark a lookup side for broadcast when asked and its row count is under
    ``starloom.join.broadcastMaxBytes`` and its hash table in the share of the driver's
    heap; otherwise leave the choice to the planner and AQE. ``known_rows`` (an upper
    bound the caller already has, e.g. the dimension's row count) saves the counting job."""
    return _side(side, broadcast, known_rows)


def join_side(df: DataFrame, side: DataFrame, left_key: str, at: str | None = None) -> DataFrame:
    """Left join of a prepared dimension side (see :func:`dim_side`)."""
    cond = df[left_key] == side[_RK]
    if _EFF in side.columns:
        if at is None:
            raise ValueError("as_of lookup needs the date column 'at'")
        at_date = df[at].cast("date")
        cond = cond & (at_date >= side[_EFF]) & (at_date < side[_EXP])
    return df.join(side, cond, "left").drop(_RK, _EFF, _EXP)


def dim_lookup(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, out_col: str,
               version: str = "current", at: str | None = None,
               sk_col: str = conf.SK_COL, broadcast: bool | str = "auto") -> DataFrame:
    """Resolve a natural key to a dimension surrogate key.

    ``version``:
      * ``"current"``: the open row (``current_flag``), at most one per key;
      * ``"as_of"``: the version valid at ``df[at]`` (a date), half-open
        ``[effective_date, expiration_date)`` so empty intervals never match;
      * ``"all"``: every version (one output row per version: fan-out).
    """
    side = checked_side(dim_side(dim, dim_key, out_col, version, sk_col), broadcast)
    return join_side(df, side, left_key, at)
