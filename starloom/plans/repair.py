"""Repair of the sales fact after a back-dated change of a dimension.

A fact row built as of its order date points to the version that was valid then. When
versions arrive late (a change that holds from a past day), rows dated in the changed
stretch of a key's history point to the wrong version. Instead of a rebuild:

1. versions that only the old or only the new history has give, for each natural key,
   the stretch of days in which its version may differ;
2. the headers of those keys dated in their stretch are the orders to repair (a scan
   of three header columns, joined with the few stretches);
3. the versions of these orders before and after are looked up; orders whose version
   is the same are left alone;
4. the months of the others are rewritten, only their key column changing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import conf
from starloom.operators.as_of import as_of_lookup
from starloom.operators.lookup import checked_side
from starloom.session import materialize


def changed_stretches(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, _from, _to): the days [from, to) in which a key's versions differ."""
    columns = [key, conf.SK_COL, conf.EFFECTIVE_COL, conf.EXPIRATION_COL]
    counted = old.select(*columns, F.lit(1).alias("_side")).unionByName(new.select(*columns, F.lit(-1).alias("_side")))
    return (counted.groupBy(*columns).agg(F.sum("_side").alias("_side")).filter("_side <> 0")
            .groupBy(key).agg(F.min(conf.EFFECTIVE_COL).alias("_from"), F.max(conf.EXPIRATION_COL).alias("_to")))


def orders_to_repair(header: DataFrame, old: DataFrame, new: DataFrame, header_key: str, dim_key: str) -> DataFrame:
    """(salesorderid, orderdate, _new_key): orders whose version on their date is
    another one now."""
    stretches = materialize(changed_stretches(old, new, dim_key))
    side = checked_side(stretches.withColumnRenamed(dim_key, "_dim_key"), True)
    orders = header.select("salesorderid", header_key, F.col("orderdate").cast("date").alias("orderdate"))
    inside = ((F.col(header_key) == F.col("_dim_key")) & (F.col("orderdate") >= F.col("_from"))
              & (F.col("orderdate") < F.col("_to")))
    met = orders.join(side, inside, "left_semi")
    keys = stretches.select(dim_key)
    for name, dim in (("_old_key", old), ("_new_key", new)):
        met = as_of_lookup(met, dim.join(checked_side(keys, True), dim_key, "left_semi"), header_key, dim_key, name, "orderdate")
    return met.filter(~F.col("_old_key").eqNullSafe(F.col("_new_key"))).select("salesorderid", "orderdate", "_new_key")


def repaired_months(fact: DataFrame, header: DataFrame, old: DataFrame, new: DataFrame, header_key: str,
                    dim_key: str, fact_column: str) -> tuple[DataFrame, DataFrame]:
    """(months, rows): the months of the fact that hold orders to repair, and the whole
    new content of these months. ``fact`` has ``order_month`` (its partition); the
    months reach its scan as a filter."""
    orders = materialize(orders_to_repair(header, old, new, header_key, dim_key))
    # One row for each month of the fact at most.
    months = orders.select(F.trunc("orderdate", "month").alias("order_month")).distinct()
    wanted = [r[0] for r in months.collect()]
    inside = F.col("order_month").isin(wanted) if wanted else F.lit(False)
    side = checked_side(orders.select(F.col("salesorderid").alias("_order"), "_new_key", F.lit(True).alias("_met")), True)
    rows = fact.filter(inside).join(side, F.col("salesorderid") == F.col("_order"), "left")
    fixed = F.when(F.col("_met"), F.col("_new_key")).otherwise(F.col(fact_column))
    return months, rows.withColumn(fact_column, fixed).select(*fact.columns)
