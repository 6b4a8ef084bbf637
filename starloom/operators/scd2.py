"""Type-2 slowly changing dimensions.

History rows carry the staging columns plus ``sk_id``, ``effective_date``,
``expiration_date`` (open = 9999-12-31, half-open intervals) and
``current_flag``.

The merge classifies every key with ONE full outer join of the open history
and the current staging rows (null-safe on the key, side presence taken from
the joined structs, not from key NULL tests), then emits rows per action:

    NOCHANGE  history row kept
    DELETE    history row closed at the load date
    UPDATE    history row closed, current row opened with a new key
    INSERT    current row opened with a new key

Closed history never enters the join; it is appended. New keys continue after
the history's maximum: inserts first, then updates, each in natural-key order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import conf
from starloom.functions.scalar import date_literal, row_fingerprint, row_fingerprint_safe
from starloom.operators.keys import assign_surrogate_keys, max_surrogate_key
from starloom.session import materialize, run_concurrently

FINGERPRINTS: dict[str, Callable[[Sequence[str]], Column]] = {
    "safe": row_fingerprint_safe,
    "plain": row_fingerprint,
}


@dataclass(frozen=True)
class DimensionSpec:
    """One SCD2 dimension: target name, staging table, natural key and the
    tracked (type-2) columns."""
    name: str
    staging: str
    key: str
    tracked: tuple[str, ...]


def key_stats(df: DataFrame, key: str) -> tuple[int, int]:
    """(rows, keys occurring more than once) in one aggregation job."""
    row = (df.groupBy(key).count()
             .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
                  F.coalesce(F.sum(F.when(F.col("count") > 1, 1).otherwise(0)), F.lit(0))
                  .alias("dups"))
             .first())
    return int(row["rows"]), int(row["dups"])


def check_unique_key(df: DataFrame, key: str) -> int:
    """Fail when a natural key repeats (NULL counts as one value); returns
    the row count."""
    rows, dups = key_stats(df, key)
    if dups:
        raise ValueError(f"natural key {key!r} is not unique: {dups} values repeat")
    return rows


def open_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col(conf.CURRENT_COL) == F.lit(True))


def closed_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col(conf.CURRENT_COL) == F.lit(False))


def _scd2_columns(load_date) -> dict[str, Column]:
    return {
        conf.EFFECTIVE_COL: date_literal(load_date),
        conf.EXPIRATION_COL: date_literal(conf.OPEN_END_DATE),
        conf.CURRENT_COL: F.lit(True),
    }


def scd2_initial(staging: DataFrame, key: str, load_date, check_unique: bool = True,
                 stats: dict | None = None) -> DataFrame:
    """First load: every staging row opened, keys 1..n in natural-key order.
    ``stats`` (a dict) receives ``rows``, the row count found by the key
    check (all rows are open)."""
    rows = check_unique_key(staging, key) if check_unique else None
    if stats is not None and rows is not None:
        stats["rows"] = rows
    keyed = assign_surrogate_keys(staging, key, start=0, rows=rows)
    return keyed.withColumns(_scd2_columns(load_date)).select(*staging.columns, *conf.SCD2_COLUMNS)


def scd2_classify(history_open: DataFrame, current: DataFrame, key: str,
                  tracked: Sequence[str], fingerprint: str = "safe") -> DataFrame:
    """Full outer join of open history and current rows on the natural key.

    Returns columns ``h`` (history row struct or NULL), ``c`` (current row
    struct or NULL), ``key`` and ``action``."""
    fp = FINGERPRINTS[fingerprint]
    h = history_open.select(F.struct(*history_open.columns).alias("h"),
                            F.col(key).alias("_hk"), fp(list(tracked)).alias("_hfp"))
    c = current.select(F.struct(*current.columns).alias("c"),
                       F.col(key).alias("_ck"), fp(list(tracked)).alias("_cfp"))
    joined = h.join(c, h["_hk"].eqNullSafe(c["_ck"]), "full_outer")
    in_h, in_c = F.col("h").isNotNull(), F.col("c").isNotNull()
    action = (F.when(in_h & in_c & (F.col("_hfp") == F.col("_cfp")), F.lit(conf.NOCHANGE))
               .when(~in_c, F.lit(conf.DELETE))
               .when(~in_h, F.lit(conf.INSERT))
               .otherwise(F.lit(conf.UPDATE)))
    return joined.select("h", "c", F.coalesce("_hk", "_ck").alias("key"), action.alias("action"))


def _conform_history(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in history.columns]
    if missing:
        raise ValueError(f"history lacks columns {missing}")
    return history.select(
        *[c for c in columns if c not in conf.SCD2_COLUMNS],
        F.col(conf.SK_COL).cast("long").alias(conf.SK_COL),
        F.col(conf.EFFECTIVE_COL).cast("date").alias(conf.EFFECTIVE_COL),
        F.col(conf.EXPIRATION_COL).cast("date").alias(conf.EXPIRATION_COL),
        F.col(conf.CURRENT_COL).cast("boolean").alias(conf.CURRENT_COL))


def scd2_merge(history: DataFrame, current: DataFrame, key: str, tracked: Sequence[str],
               load_date, fingerprint: str = "safe", check_unique: bool = True,
               with_action: bool = False, stats: dict | None = None,
               max_sk: int | None = None) -> DataFrame:
    """Merge the current staging rows into the SCD2 history (see module doc).

    ``with_action`` adds the action that produced each row (NULL for history
    that was already closed). ``stats`` (a dict) receives ``rows``, the
    number of open rows after the merge (one per current staging row).
    ``max_sk``, when the caller keeps it, is the history's max surrogate key
    (saves scanning the whole history for it)."""
    base_cols = list(current.columns)
    out_cols = base_cols + list(conf.SCD2_COLUMNS)
    history = _conform_history(history, out_cols)
    # Two independent small jobs: key check over staging, max key over history.
    known_max = max_sk
    scalars = run_concurrently({
        "rows": lambda: check_unique_key(current, key) if check_unique else None,
        "max_sk": lambda: known_max if known_max is not None else max_surrogate_key(history),
    })
    rows, max_sk = scalars["rows"], scalars["max_sk"]
    if stats is not None and rows is not None:
        stats["rows"] = rows
    load = date_literal(load_date)

    open_h = open_rows(history)
    # Closed history passes through; a NULL flag is kept as history too.
    closed_h = history.filter(~F.coalesce(F.col(conf.CURRENT_COL) == F.lit(True), F.lit(False)))
    # Read by the key numbering and by both outputs: the join runs once.
    cls = materialize(scd2_classify(open_h, current, key, tracked, fingerprint))

    action = F.col("action")
    is_nochange = action == F.lit(conf.NOCHANGE)
    kept = (cls.filter(action.isin(conf.NOCHANGE, conf.DELETE, conf.UPDATE))
               .select(*[F.col(f"h.{c}").alias(c) for c in base_cols],
                       F.col(f"h.{conf.SK_COL}").alias(conf.SK_COL),
                       F.col(f"h.{conf.EFFECTIVE_COL}").alias(conf.EFFECTIVE_COL),
                       F.when(is_nochange, F.col(f"h.{conf.EXPIRATION_COL}")).otherwise(load)
                        .alias(conf.EXPIRATION_COL),
                       F.when(is_nochange, F.col(f"h.{conf.CURRENT_COL}")).otherwise(F.lit(False))
                        .alias(conf.CURRENT_COL),
                       action))
    opened = (cls.filter(action.isin(conf.INSERT, conf.UPDATE))
                 .select(*[F.col(f"c.{c}").alias(c) for c in base_cols], action,
                         F.when(action == F.lit(conf.INSERT), 0).otherwise(1).alias("_seg")))
    # New versions come from current rows: their count is bounded by ``rows``.
    opened = (assign_surrogate_keys(opened, key, start=max_sk, segment_col="_seg", rows=rows)
              .withColumns(_scd2_columns(load_date))
              .select(*out_cols, "action"))
    result = (closed_h.withColumn("action", F.lit(None).cast("string"))
                      .unionByName(kept).unionByName(opened))
    return result if with_action else result.drop("action")
