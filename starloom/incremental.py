"""Named queries of the incremental operators: staged tables, dimensions and facts kept
by changes rather than rebuilt. Importing this module adds them to
:data:`starloom.registry.QUERIES`; their SQL, in :mod:`starloom.oracle_incremental`,
states the full rebuild that each must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import conf
from starloom.operators import cdc, delta, evolve, home, scd2, scd2_digest, scd2_log, support
from starloom.operators.as_of import as_of_lookup
from starloom.operators.lookup import lookup
from starloom.plans import daily_run, dimensions, facts, repair, scenarios, staging
from starloom.registry import CUSTOMER, query, _new_root, _order_lines
from starloom.functions.scalar import date_literal, decode_order_status
from starloom.session import materialize
from starloom.sources import bucketed, statistics
from starloom.sources.fixture_changes import ChangedSource
from starloom.sources.fixtures import FixtureSource

# Fixed scenario values.
LOG_START = "2024-02-01"
LOG_EVENTS, LOG_DAYS = 4, 20
BACKDATED = "1997-01-01"
HOME_BLOCK = 5000
ADDRESS = dimensions.DIMENSION_BY_NAME["dim_address"]


# -- staging by changes -------------------------------------------------------------

def _staged_by_changes(src: FixtureSource, name: str) -> DataFrame:
    changes, build = ChangedSource(src), staging.STAGING_BUILDERS[name]
    change = delta.stage_delta(build, staging.LINEAGE[name], changes.after, changes.changed)
    return delta.apply_delta(build(changes.before), change)


@query
def stg_delta_address(src: FixtureSource) -> DataFrame:
    """Staged addresses after new, changed, moved and deleted ones, a renamed state and
    country, and a state that changed its country."""
    return _staged_by_changes(src, "stg_dim_address")


@query
def stg_delta_customer(src: FixtureSource) -> DataFrame:
    return _staged_by_changes(src, "stg_dim_customer")


@query
def stg_delta_product(src: FixtureSource) -> DataFrame:
    return _staged_by_changes(src, "stg_dim_product")


@query
def scd2_merge_delta(src: FixtureSource) -> DataFrame:
    """The address dimension after a first load of the old state and a merge of the
    day's staging change alone."""
    changes, build = ChangedSource(src), staging.STAGING_BUILDERS[ADDRESS.staging]
    history = scd2.scd2_initial(build(changes.before), ADDRESS.key, scenarios.FIRST_LOAD_DATE)
    change = delta.stage_delta(build, staging.LINEAGE[ADDRESS.staging], changes.after, changes.changed)
    return delta.scd2_merge_delta(history, change, ADDRESS.tracked, scenarios.MERGE_LOAD_DATE)


@query
def daily_run_fact(src: FixtureSource) -> DataFrame:
    """The stored sales fact after two daily runs: a first load of the old state, then
    the day's changes of every source."""
    changes, root = ChangedSource(src), _new_root(src, "daily")
    daily_run.run_daily(src.spark, changes.before, root, scenarios.FIRST_LOAD_DATE)
    daily_run.run_daily(src.spark, changes.after, root, scenarios.MERGE_LOAD_DATE)
    return daily_run.read_fact(src.spark, root)


# -- distinct values kept by counts ---------------------------------------------------

def _support(src: FixtureSource, column: str, not_null: bool) -> DataFrame:
    """Counts of the live orders' values, after the day's changed orders."""
    changes, name = ChangedSource(src), "sales_salesorderheader"

    def counted(df: DataFrame) -> DataFrame:
        df = cdc.live_rows(df)
        return (cdc.not_null(df, column) if not_null else df).select(column)
    # Stored with the table by the last run.
    counts = materialize(support.support_counts(counted(changes.before(name)), column))
    # A change log carries the rows as they were; here they are found by key.
    now = changes.changed(name)
    were = changes.before(name).join(now.select("salesorderid"), "salesorderid", "left_semi")
    return support.change_support(counts, counted(were), counted(now), column)


@query
def support_counts(src: FixtureSource) -> DataFrame:
    """Live orders by status (NULL is a value) after the day's changes."""
    return _support(src, "status", not_null=False)


@query
def stg_delta_order_status(src: FixtureSource) -> DataFrame:
    codes = support.supported_values(_support(src, "status", not_null=False), "status")
    return codes.select(F.col("status").alias("order_status"), decode_order_status("status").alias("order_status_name"))


@query
def stg_delta_credit_card(src: FixtureSource) -> DataFrame:
    used = support.supported_values(_support(src, "creditcardid", not_null=True), "creditcardid")
    return lookup(used, cdc.live_rows(src("sales_creditcard")), "creditcardid", ["cardtype"]).select(
        "creditcardid", "cardtype")


# -- dimensions -------------------------------------------------------------------------

@query
def scd2_merge_digest(src: FixtureSource) -> DataFrame:
    """The customer merge, on a history stored by bucket: only buckets whose digests
    differ are read by the join."""
    root, buckets = _new_root(src, "buckets"), 256
    scd2_digest.with_bucket(scenarios.customer_history(src), CUSTOMER.key, buckets).write.partitionBy(
        scd2_digest.BUCKET).parquet(root)
    return scd2_digest.scd2_merge_by_digest(src.spark.read.parquet(root), scenarios.customer_batch2(src), CUSTOMER.key,
                                            CUSTOMER.tracked, scenarios.MERGE_LOAD_DATE, buckets=buckets)


def customer_log(src: FixtureSource) -> DataFrame:
    """Several events of each of two thirds of the customers, over a few weeks: changes
    of name (two of them alike), deletes, returns, and unknown delete flags."""
    n, k = F.col("seq"), F.col("customerid")
    rows = staging.stg_dim_customer(src).filter(k % 3 != 1).withColumn(
        "seq", F.explode(F.sequence(F.lit(1), F.lit(LOG_EVENTS))))
    return rows.withColumns({
        "fullname": F.concat(F.coalesce("fullname", F.lit("")), F.lit("_e"), F.expr("seq div 2").cast("string")),
        "day": F.date_add(date_literal(LOG_START), ((k * 3 + n * 5) % LOG_DAYS).cast("int")),
        conf.DELETED_FLAG: F.when((k + n) % 17 == 0, F.lit(None)).otherwise((k + n) % 5 == 0)})


@query
def scd2_change_log(src: FixtureSource) -> DataFrame:
    """The customer history after a log of several events a key."""
    return scd2_log.scd2_apply_log(scenarios.customer_history(src), customer_log(src), CUSTOMER.key, CUSTOMER.tracked,
                                   "day", ["seq"])


def _older_history(src: FixtureSource) -> DataFrame:
    """The customer history before stores had names, its ids still 32 bits wide."""
    return scenarios.customer_history(src).drop("storename").withColumns(
        {c: F.col(c).cast("int") for c in ("businessentityid", "storebusinessentityid")})


@query
def scd2_merge_evolved(src: FixtureSource) -> DataFrame:
    """An older schema's history merged; a filled new column is a change."""
    return evolve.scd2_merge_evolved(_older_history(src), scenarios.customer_batch2(src), CUSTOMER.key,
                                     CUSTOMER.tracked, scenarios.MERGE_LOAD_DATE)


@query
def scd2_merge_evolved_fill(src: FixtureSource) -> DataFrame:
    """The same where unchanged versions take the new column's values."""
    return evolve.scd2_merge_evolved(_older_history(src), scenarios.customer_batch2(src), CUSTOMER.key,
                                     CUSTOMER.tracked, scenarios.MERGE_LOAD_DATE, added="fill")


@query
def max_key_from_files(src: FixtureSource) -> DataFrame:
    """Greatest order and customer keys, from file footers."""
    return statistics.max_from_files(src.spark, f"{src.sf_dir}/orders.parquet", "o_orderkey", "o_custkey")


# -- facts ---------------------------------------------------------------------------------

def _bucketed_orders(src: FixtureSource) -> bucketed.BucketedOrders:
    return bucketed.land_bucketed(src.spark, scenarios.landed_detail(src), scenarios.landed_header(src),
                                  _new_root(src, "orders"), buckets=16)


@query
def join_inner_bucketed(src: FixtureSource) -> DataFrame:
    """Lines x headers, stored in buckets of the order id."""
    return bucketed.join_lines(_bucketed_orders(src)).select(
        "salesorderid", "salesorderdetailid", "orderqty", "customerid", F.col("orderdate").cast("date").alias("orderdate"))


@query
def sales_fact_bucketed(src: FixtureSource) -> DataFrame:
    rows: dict[str, int] = {}
    dims = scenarios.first_load_dims(src, rows=rows)
    return facts.sales_fact_bucketed(_bucketed_orders(src), dims, dim_rows=rows)


@query
def dim_lookup_as_of_sorted(src: FixtureSource) -> DataFrame:
    """As-of lookup by one sorted pass over lines and versions."""
    dim = scenarios.customer_merged(src, as_of_dates=True)
    return as_of_lookup(_order_lines(src), dim, "customerid", "customerid", "customer_key", "orderdate")


@query
def upsert_home_rows(src: FixtureSource) -> DataFrame:
    """Stored headers (by order-id block) of the orders changed after the cut-off, the
    blocks chosen at run time."""
    root = _new_root(src, "home")
    headers = src("sales_salesorderheader")

    def block(c: str):
        return F.floor(F.col(c) / F.lit(HOME_BLOCK)).cast("long")
    headers.withColumn("order_block", block("salesorderid")).write.partitionBy("order_block").parquet(root)
    changed = cdc.after_watermark(headers, "modifieddate", F.lit(scenarios.LANDING_CUTOFF).cast("timestamp_ntz"))
    stored = src.spark.read.parquet(root)
    return home.rows_at_home(stored, changed, "salesorderid", "order_block", block("salesorderid")).select(*headers.columns)


def backdated_customers(dim: DataFrame) -> DataFrame:
    """The merged customers, once it is known that a change of every second changed or
    new customer held from an earlier day."""
    late = F.col("customerid") % 2 == 0
    merge, earlier = date_literal(scenarios.ASOF_MERGE_LOAD), date_literal(BACKDATED)
    return dim.withColumns({c: F.when(late & (F.col(c) == merge), earlier).otherwise(F.col(c))
                            for c in (conf.EFFECTIVE_COL, conf.EXPIRATION_COL)})


@query
def sales_fact_repaired(src: FixtureSource) -> DataFrame:
    """A stored as-of fact after a back-dated change of customers: only the months with
    orders whose version changed are rewritten."""
    path = _new_root(src, "repair")
    detail, header = scenarios.landed_detail(src), scenarios.landed_header(src)
    dims = scenarios.first_load_dims(src, load_date=scenarios.ASOF_FIRST_LOAD)
    old = materialize(scenarios.customer_merged(src, as_of_dates=True))
    fact = facts.sales_fact(detail, header, dims | {"dim_customer": old}, version="as_of")
    (fact.withColumn("order_month", F.trunc("orderdate", "month")).write.partitionBy("order_month").parquet(path))
    stored = src.spark.read.schema(fact.withColumn("order_month", F.trunc("orderdate", "month")).schema).parquet(path)
    _, rows = repair.repaired_months(stored, header, old, backdated_customers(old), "customerid", "customerid", "customer_key")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("order_month").parquet(path))
    return src.spark.read.schema(stored.schema).parquet(path).drop("order_month")
