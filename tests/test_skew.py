"""A hot key holding a third of the rows: results stay whole and AQE splits
the skewed partition of the shuffle join instead of running it in one task."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from starloom.operators import cdc
from starloom.plans import facts

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Initial Plan ==")[0]


def test_hot_order_is_split_and_complete(spark):
    n = 30000
    lines = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 10).alias("salesorderid"),
        F.col("id").alias("salesorderdetailid"), (F.col("id") % 50).alias("productid"),
        F.lit(2).alias("orderqty"), F.lit("1.50").cast("decimal(12,2)").alias("unitprice"))
    orders = spark.range(n + 20).select(
        F.col("id").alias("salesorderid"), (F.col("id") % 100).alias("customerid"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 100).alias("creditcardid"),   # 20% NULL
        (F.col("id") % 100).alias("shiptoaddressid"), (F.col("id") % 7).cast("int").alias("status"),
        F.lit(dt.datetime(2001, 1, 1)).alias("orderdate"))
    dim = spark.range(100).select(F.col("id").alias("k"), (F.col("id") + 1).alias("sk_id"),
                                  F.lit(True).alias("current_flag"))
    dims = {
        "dim_orderstatus": dim.withColumnRenamed("k", "order_status"),
        "dim_creditcard": dim.withColumnRenamed("k", "creditcardid"),
        "dim_product": dim.withColumnRenamed("k", "productid"),
        "dim_address": dim.withColumnRenamed("k", "addressid"),
        "dim_customer": dim.withColumnRenamed("k", "customerid"),
    }
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        fact = facts.sales_fact(lines, orders, dims)   # dimensions checked and broadcast
        plan = final_plan(fact)
        assert "skew=true" in plan
        assert fact.count() == n
        assert fact.filter("salesorderid = 1").count() == n // 3
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_is_combined_before_the_shuffle(spark):
    """Newest row per key with one key holding a third of the rows: every
    task reduces it to one row before the shuffle."""
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("ts"), F.lit("x").alias("v"))
    out = cdc.newest_per_key(df.repartition(8), ["k"], ["ts"])
    assert out.count() == n - n // 3 + 1
    assert out.filter("k = 0").first()["ts"] == max(i for i in range(n) if i % 3 == 0)


def test_null_lookup_keys_are_split_in_a_shuffle_join(spark):
    """A dimension too big to broadcast is shuffle-joined; a third of the
    driving rows have a NULL key, which all hash to one partition. AQE
    splits that partition of the driving side (left outer join)."""
    from starloom.operators.lookup import dim_lookup
    n = 30000
    driving = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 1000).alias("k"))
    dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("sk_id"),
                                   F.lit(True).alias("current_flag"))
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    spark.conf.set("starloom.join.broadcastMaxBytes", "320")   # too big to broadcast
    try:
        out = dim_lookup(driving, dim, "k", "k", "key", broadcast=True)
        plan = final_plan(out)
        assert "SortMergeJoin(skew=true)" in plan and "LeftOuter" in plan
        assert out.count() == n and out.filter("key is null").count() == n // 3
    finally:
        spark.conf.unset("starloom.join.broadcastMaxBytes")
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
