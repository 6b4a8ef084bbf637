"""As-of lookup as one sorted pass.

An equi-join on the natural key lets every line meet every version of its key before
the dates are compared. Here lines and versions are one table in order of key and
date, and a window carries the last version forward, so there are never more rows
than lines and versions together, whatever number of versions a key has.

A line has the version that began last on or before its date, if that version has not
ended by then; empty intervals (ended the day they began) are left out first, and the
intervals of a key must not overlap, as those of SCD2 history do not.

A key with more than ``starloom.asOf.rowsPerRange`` lines is cut into ranges of dates
of about that many lines, each sorted by itself; a date with more lines than that is
dealt over several ranges. A range begins with the last version of the ranges before
it. Lines without a key or a date have no version and are dealt over ranges as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom import conf
from starloom.operators.lookup import checked_side
from starloom.session import materialize

_VERSION = ("_until", "_sk")
#: Ranges that lines without a key or a date are dealt over.
_LOOSE = 1024


def _keyed(df: DataFrame, left_key: str, at: str) -> DataFrame:
    day = F.col(at).cast("date")
    return df.withColumns({"_key": F.when(day.isNotNull(), F.col(left_key)), "_day": day})


def _nonempty(dim: DataFrame, dim_key: str, sk_col: str) -> DataFrame:
    begin, end = F.col(conf.EFFECTIVE_COL).cast("date"), F.col(conf.EXPIRATION_COL).cast("date")
    return dim.filter(F.col(dim_key).isNotNull() & (begin < end)).select(
        F.col(dim_key).alias("_key"), begin.alias("_day"),
        F.struct(end.alias("_until"), F.col(sk_col).alias("_sk")).alias("_version"))


def _ranges(lines: DataFrame, hot: DataFrame, n_hot: int, per: int) -> DataFrame:
    """(_key, _day, _lo, _hi): the ranges that a day of a hot key is dealt over, by
    the running number of its lines."""
    side = checked_side(hot, True, n_hot)
    days = lines.join(side, "_key", "left_semi").groupBy("_key", "_day").count()
    before = F.sum("count").over(Window.partitionBy("_key").orderBy("_day"))  # this day included
    return materialize(days.select("_key", "_day", F.floor((before - F.col("count")) / per).alias("_lo"),
                                   F.floor((before - 1) / per).alias("_hi")))


def _placed_versions(versions: DataFrame, hot: DataFrame, n_hot: int, ranges: DataFrame) -> DataFrame:
    """Versions with their range: that of the first line day they can matter to."""
    side = checked_side(hot.withColumn("_is_hot", F.lit(True)), True, n_hot)
    marked = versions.join(side, "_key", "left")
    own = marked.filter("_is_hot").drop("_is_hot")
    days = ranges.select("_key", "_day", F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"), "_lo")
    following = Window.partitionBy("_key").orderBy("_day", F.col("_version").isNull()).rowsBetween(
        0, Window.unboundedFollowing)
    # Beyond the last line day no line looks at it.
    placed = (own.withColumn("_lo", F.lit(None).cast("long")).unionByName(days)
              .withColumn("_range", F.first("_lo", ignorenulls=True).over(following))
              .filter(F.col("_version").isNotNull() & F.col("_range").isNotNull()).drop("_lo"))
    return marked.filter("_is_hot is null").drop("_is_hot").withColumn("_range", F.lit(0).cast("long")).unionByName(placed)


def _carried(placed: DataFrame, ranges: DataFrame) -> DataFrame:
    """(_key, _range, _carried): the last version before each range of a hot key."""
    every = ranges.groupBy("_key").agg(F.max("_hi").alias("_last")).select(
        "_key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))).alias("_range"))
    last = placed.groupBy("_key", "_range").agg(F.max_by("_version", "_day").alias("_version"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return (every.join(last, ["_key", "_range"], "left")
            .select("_key", "_range", F.last("_version", ignorenulls=True).over(before).alias("_carried")))


def as_of_events(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, at: str, sk_col: str = conf.SK_COL,
                 per: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Lines (``_version`` null) and versions in one table, each in its range, and the
    versions carried into ranges (None if no key is cut)."""
    per = per or int(conf.tunable(df.sparkSession, conf.AS_OF_ROWS))
    lines, versions = _keyed(df, left_key, at), _nonempty(dim, dim_key, sk_col)
    hot = materialize(lines.filter(F.col("_key").isNotNull()).groupBy("_key").count()
                      .filter(F.col("count") > per).select("_key"))
    n_hot = hot.count()  # at most lines / per
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    loose = F.when(F.col("_key").isNull(), F.pmod(spread, F.lit(_LOOSE))).otherwise(F.lit(0).cast("long"))
    carried = None
    if n_hot:
        ranges = _ranges(lines, hot, n_hot, per)
        versions = _placed_versions(versions, hot, n_hot, ranges)
        carried = _carried(versions, ranges)
        lines = lines.join(checked_side(ranges, True), ["_key", "_day"], "left")
        dealt = F.col("_lo") + F.pmod(spread, F.col("_hi") - F.col("_lo") + 1)
        lines = lines.withColumn("_range", F.coalesce(dealt, loose)).drop("_lo", "_hi")
    else:
        versions = versions.withColumn("_range", F.lit(0).cast("long"))
        lines = lines.withColumn("_range", loose)
    return lines.unionByName(versions, allowMissingColumns=True), carried


def as_of_lookup(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, out_col: str, at: str,
                 sk_col: str = conf.SK_COL, per: int | None = None) -> DataFrame:
    """``df`` with ``out_col``, the surrogate key of the version of ``dim`` that is
    valid on ``df[at]``, or NULL."""
    events, carried = as_of_events(df, dim, left_key, dim_key, at, sk_col, per)
    # A version that begins on a line's day comes before the line.
    so_far = Window.partitionBy("_key", "_range").orderBy("_day", F.col("_version").isNull()).rowsBetween(
        Window.unboundedPreceding, 0)
    walked = events.withColumn("_is_line", F.col("_version").isNull()).withColumn(
        "_version", F.last("_version", ignorenulls=True).over(so_far)).filter("_is_line")
    if carried is not None:
        walked = walked.join(checked_side(carried, True), ["_key", "_range"], "left").withColumn(
            "_version", F.coalesce("_version", "_carried"))
    return walked.select(*df.columns, F.when(F.col("_day") < F.col("_version._until"), F.col("_version._sk")).alias(out_col))
