"""Sales fact variants against straightforward recomputations."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starloom.operators import lookup
from starloom.plans import facts, scenarios
from starloom.sources.fixtures import FixtureSource


def test_all_versions_fan_out_and_as_of_lookup(spark):
    src = FixtureSource(spark, SF_SMALL)
    dims = scenarios.first_load_dims(src)
    detail, header = scenarios.landed_detail(src), scenarios.landed_header(src)
    # every version of the merged customer dimension joins: one row per version
    assert facts.sales_fact(detail, header, dims, version="all").count() == 6018
    # as-of: the customer key valid on the order date, as a direct lookup gives it
    asof_dims = dict(dims, dim_customer=scenarios.customer_merged(src, as_of_dates=True))
    fact = facts.sales_fact(detail, header, asof_dims, version="as_of")
    direct = lookup.dim_lookup(
        header.select("salesorderid", "customerid", F.col("orderdate").cast("date").alias("d")),
        asof_dims["dim_customer"], "customerid", "customerid", "k", version="as_of", at="d")
    got = fact.select("salesorderid", "customer_key").distinct()
    want = direct.join(detail.select("salesorderid").distinct(), "salesorderid") \
                 .select("salesorderid", F.col("k").alias("customer_key"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert fact.filter("customer_key is not null").count() > 0


def test_incremental_fact_with_strict_filter_skips_the_boundary_day(spark):
    src = FixtureSource(spark, SF_SMALL)
    dims = scenarios.first_load_dims(src)
    detail, header = scenarios.landed_detail(src), scenarios.landed_header(src)
    full = facts.sales_fact(detail, header, dims)
    target = scenarios.upsert_target(full)
    since = target.agg(F.max("orderdate")).first()[0]
    strict = facts.sales_fact(detail, header, dims, since=since, strict=True)
    inclusive = facts.sales_fact(detail, header, dims, since=since)
    assert strict.filter(F.col("orderdate") <= F.lit(since)).count() == 0
    assert inclusive.filter(F.col("orderdate") == F.lit(since)).count() > 0


def test_dimensions_are_broadcast_while_the_drivers_heap_has_room_for_all(spark):
    """Each of them is under the bound for one side; their hash tables are in the driver together."""
    src = FixtureSource(spark, SF_SMALL)
    dims = scenarios.first_load_dims(src)
    detail, header = scenarios.landed_detail(src), scenarios.landed_header(src)
    want = facts.sales_fact(detail, header, dims)
    share = "starloom.join.broadcastHeapShare"
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    spark.conf.set(share, str((24 << 20) / heap))
    try:
        # rows of every dimension, and which hash tables 24 MB have room for
        for rows, fit in ((10, 5), (100_000, 2), (1_000_000, 0), (6_000_000, 0)):
            fact = facts.sales_fact(detail, header, dims, dim_rows=dict.fromkeys(dims, rows))
            assert fact._jdf.queryExecution().analyzed().toString().count("strategy=broadcast") == fit
            if fit != 5:
                assert fact.exceptAll(want).count() == 0 and want.exceptAll(fact).count() == 0
    finally:
        spark.conf.unset(share)
