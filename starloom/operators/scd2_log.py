"""SCD2 history from a change log: several events of a key between two loads.

A merge of snapshots sees only the last state of a key. A log holds every event, so a
key can change, leave and come back within one batch, each with its own validity. The
log is folded in one pass, however many days it spans:

1. events of one key and day are reduced to the last one (validity is kept in days);
2. the key's open version, if any, comes first, its events follow in order of day;
3. an event that leaves the state as it was says nothing (equal neighbours are merged,
   as is a delete of what is not there); every other one ends the state before it;
4. what is left and is not a delete opens a version that lasts to the next one, or is
   open; a delete leaves a gap.

The result equals applying the days one after the other with
:func:`starloom.operators.scd2.scd2_merge`: new keys continue after the greatest one, by
day, inserts before updates, in natural-key order. A key needs at most one row for each
day of the log in a window; the events themselves are reduced map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom import conf
from starloom.functions.scalar import date_literal
from starloom.operators.cdc import newest_per_key
from starloom.operators.keys import assign_surrogate_keys, max_surrogate_key
from starloom.operators.scd2 import FINGERPRINTS
from starloom.session import materialize


def _states(history: DataFrame, log: DataFrame, key: str, columns: Sequence[str], day: str, order: Sequence[str],
            flag: str, print_) -> DataFrame:
    """One row for each state in order: (key, _day, _live, _print, _row, and for the
    open version its SCD2 columns). An open version's day is its own beginning."""
    events = log.select(*columns, F.col(day).cast("date").alias("_day"), *order, flag)
    events = newest_per_key(events, [key, "_day"], list(order))
    # Like the delete filter of a snapshot: an unknown flag is not live.
    events = events.select(F.col(key), "_day", F.coalesce(F.col(flag) == F.lit(False), F.lit(False)).alias("_live"),
                           print_.alias("_print"), F.struct(*columns).alias("_row"),
                           *[F.lit(None).cast(history.schema[c].dataType).alias(c) for c in conf.SCD2_COLUMNS])
    opened = history.select(F.col(key), F.col(conf.EFFECTIVE_COL).alias("_day"), F.lit(True).alias("_live"),
                            print_.alias("_print"), F.struct(*columns).alias("_row"), *conf.SCD2_COLUMNS)
    return opened.unionByName(events)


def scd2_apply_log(history: DataFrame, log: DataFrame, key: str, tracked: Sequence[str], day: str,
                   order: Sequence[str], flag: str = conf.DELETED_FLAG, fingerprint: str = "safe",
                   max_sk: int | None = None) -> DataFrame:
    """History after the events of ``log``. ``log`` has the key and the tracked
    columns, ``day`` (when the event holds from), ``order`` (which of one day's events
    is later) and the delete flag. Events older than the open version of their key
    are an error: they would rewrite closed history. ``max_sk``, when kept, saves a
    scan of the history."""
    columns = [c for c in history.columns if c not in conf.SCD2_COLUMNS]
    log = materialize(log)
    if max_sk is None:
        max_sk = max_surrogate_key(history)
    is_open = F.coalesce(F.col(conf.CURRENT_COL) == F.lit(True), F.lit(False))
    keys = log.select(F.col(key).alias("_log_key")).distinct()
    met = F.col(key).eqNullSafe(F.col("_log_key"))
    opened = history.filter(is_open)
    states = _states(opened.join(keys, met, "left_semi"), log, key, columns, day, order, flag,
                     FINGERPRINTS[fingerprint](list(tracked)))
    # The open version first, also before an event of the day that it began.
    stored = F.col(conf.SK_COL).isNotNull()
    by_day = Window.partitionBy(key).orderBy(F.when(stored, 0).otherwise(1), "_day")
    was_live = F.coalesce(F.lag("_live").over(by_day), F.lit(False))
    same = F.when(F.col("_live") & was_live, F.col("_print") == F.lag("_print").over(by_day)).otherwise(
        F.col("_live") == was_live)
    late = F.first(F.when(stored, F.col("_day")), ignorenulls=True).over(by_day) > F.col("_day")
    # Read three times below (late events, numbering, both outputs).
    changes = materialize(states.withColumns({"_same": same, "_update": was_live, "_late": F.coalesce(late, F.lit(False))})
                          .filter(stored | ~F.col("_same") | F.col("_late")))
    n_late = changes.filter("_late").count()
    if n_late:
        raise ValueError(f"{n_late} events are older than the open version of their key")
    until = F.lead("_day").over(by_day)
    ended = changes.withColumn("_until", until)
    end = F.coalesce("_until", date_literal(conf.OPEN_END_DATE))
    kept = ended.filter(stored).select(
        "_row.*", conf.SK_COL, conf.EFFECTIVE_COL,
        F.when(F.col("_until").isNull(), F.col(conf.EXPIRATION_COL)).otherwise(F.col("_until")).alias(conf.EXPIRATION_COL),
        F.col("_until").isNull().alias(conf.CURRENT_COL))
    new = ended.filter(~stored & F.col("_live")).select(
        "_row.*", F.col("_day").alias(conf.EFFECTIVE_COL), end.alias(conf.EXPIRATION_COL),
        F.col("_until").isNull().alias(conf.CURRENT_COL),
        # A segment for each day and action: inserts, then updates.
        (F.unix_date("_day") * 2 + F.col("_update").cast("int")).alias("_segment"))
    new = assign_surrogate_keys(new, key, start=max_sk, segment_col="_segment")
    passed = history.filter(~is_open).unionByName(opened.join(keys, met, "left_anti"))
    out = [*columns, *conf.SCD2_COLUMNS]
    return passed.select(*out).unionByName(kept.select(*out)).unionByName(new.select(*out))
