"""Named queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the shared test tables. Matching DuckDB
SQL lives in :mod:`starloom.oracle` under the same names and column names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import conf
from starloom.functions import scalar
from starloom.operators import cdc, columns, keys, lookup, scd2, upsert
from starloom.plans import dimensions, facts, scenarios, staging
from starloom.sources.fixtures import FixtureSource
from starloom.session import ensure_checkpoint_dir, materialize, run_concurrently
from starloom.sources import publish
from starloom.sources.tables import path_has_data, scan

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[FixtureSource], DataFrame]) -> Callable[[FixtureSource], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(FixtureSource(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


CUSTOMER = scenarios.CUSTOMER


# -- 2.1 scans, sources, sinks ----------------------------------------------------

@query
def src_scan(src: FixtureSource) -> DataFrame:
    """Source table through the generic scan, by its name in the catalog."""
    name = f"oltp_header_{publish.new_run_id().replace('-', '_')}"
    src("sales_salesorderheader").createOrReplaceTempView(name)
    return scan(src.spark, name)


@query
def src_parquet_scan(src: FixtureSource) -> DataFrame:
    """Parquet dataset scan with column pruning."""
    df = scan(src.spark, f"{src.sf_dir}/lineitem.parquet", "parquet")
    return df.select(F.col("l_orderkey").alias("salesorderid"),
                     F.col("l_linenumber").alias("linenumber"),
                     F.col("l_shipdate").alias("modifieddate"))


@query
def drop_metadata(src: FixtureSource) -> DataFrame:
    """Ingestion metadata dropped (absent names ignored)."""
    return columns.drop_metadata(src("sales_salesorderdetail"))


@query
def load_metrics(src: FixtureSource) -> DataFrame:
    """Rows per staged table, observed while each is written."""
    root = _new_root(src, "staged")
    rows = run_concurrently({name: (lambda n=name, b=build: publish.overwrite(b(src), f"{root}/{n}")["rows"])
                             for name, build in staging.STAGING_BUILDERS.items()})
    return src.spark.createDataFrame(list(rows.items()), "table_name string, row_count long")


# -- 2.2 projection, filter ------------------------------------------------------

@query
def filter_soft_delete(src: FixtureSource) -> DataFrame:
    return cdc.live_rows(src("sales_customer"))


@query
def filter_not_null(src: FixtureSource) -> DataFrame:
    return cdc.not_null(src("sales_salesorderheader"), "creditcardid") \
              .select("salesorderid", "creditcardid")


@query
def watermark_increment(src: FixtureSource) -> DataFrame:
    """Detail rows (any flag) strictly after the landing cut-off."""
    return cdc.after_watermark(src("sales_salesorderdetail"), "modifieddate",
                               F.lit(scenarios.LANDING_CUTOFF).cast("timestamp_ntz"), strict=True)


@query
def fact_incremental_filter(src: FixtureSource) -> DataFrame:
    """Fact rows dated after max(orderdate) of an older fact (faithful ``>``)."""
    since = facts.order_watermark(scenarios.landed_detail(src), scenarios.landed_header(src), scenarios.UPSERT_TARGET_END)
    return scenarios.current_fact(src, since=since, strict=True)


@query
def scd2_open_rows(src: FixtureSource) -> DataFrame:
    return scd2.open_rows(scenarios.customer_history(src))


@query
def scd2_closed_rows(src: FixtureSource) -> DataFrame:
    return scd2.closed_rows(scenarios.customer_history(src))


@query
def scd2_changes_only(src: FixtureSource) -> DataFrame:
    cls = _classified(src)
    return cls.filter(F.col("action") != F.lit(conf.NOCHANGE))


@query
def project_alias(src: FixtureSource) -> DataFrame:
    return columns.project(src("sales_salesorderheader"), {
        "salesorderid": "salesorderid", "customerid": "customerid",
        "order_status": "status", "ship_to": "shiptoaddressid"})


@query
def conform_columns(src: FixtureSource) -> DataFrame:
    """Staged customers with extra and reordered columns, conformed to the
    history's column list."""
    history = scenarios.customer_history(src)
    rows = staging.stg_dim_customer(src)
    wide = rows.select(F.lit("x").alias("extra"), *reversed(rows.columns),
                     F.lit(0).cast("long").alias(conf.SK_COL),
                     F.lit(scenarios.MERGE_LOAD_DATE).cast("date").alias(conf.EFFECTIVE_COL),
                     F.lit(conf.OPEN_END_DATE).cast("date").alias(conf.EXPIRATION_COL),
                     F.lit(True).alias(conf.CURRENT_COL))
    return columns.conform_columns(wide, history)


@query
def rename_suffix(src: FixtureSource) -> DataFrame:
    return columns.rename_suffix(staging.stg_dim_credit_card(src), "_current", append=True)


@query
def dim_date(src: FixtureSource) -> DataFrame:
    return dimensions.dim_date(staging.stg_date(src))


# -- 2.3 joins -------------------------------------------------------------------

@query
def join_left_chain(src: FixtureSource) -> DataFrame:
    """address -> state -> country, keeping the intermediate keys."""
    address = cdc.live_rows(src("person_address"))
    state = cdc.live_rows(src("person_stateprovince"))
    country = cdc.live_rows(src("person_countryregion"))
    df = lookup.lookup(address, state, "stateprovinceid",
                       {"countryregioncode": "countryregioncode", "state_name": "name"})
    df = lookup.lookup(df, country, "countryregioncode", {"country_name": "name"})
    return df.select("addressid", "stateprovinceid", "countryregioncode", "state_name",
                     "country_name")


@query
def join_left_star(src: FixtureSource) -> DataFrame:
    customer = cdc.live_rows(src("sales_customer"))
    person = cdc.live_rows(src("person_person"))
    store = cdc.live_rows(src("sales_store"))
    df = lookup.lookup(customer, person, ("personid", "businessentityid"),
                       {"lastname": "lastname"})
    df = lookup.lookup(df, store, ("storeid", "businessentityid"), {"storename": "name"})
    return df.select("customerid", "personid", "storeid", "lastname", "storename")


@query
def join_distinct_left(src: FixtureSource) -> DataFrame:
    """Distinct card ids used by live orders, then card details."""
    used = lookup.distinct_keys(cdc.live_rows(src("sales_salesorderheader")), "creditcardid")
    return lookup.lookup(used, src("sales_creditcard"), "creditcardid",
                         {"cardtype": "cardtype", "card_deleted": "_deleted"})


@query
def join_full_outer(src: FixtureSource) -> DataFrame:
    h = scd2.open_rows(scenarios.customer_history(src)).select(
        F.col("customerid").alias("h_customerid"), F.col("fullname").alias("h_fullname"))
    c = scenarios.customer_batch2(src).select(
        F.col("customerid").alias("c_customerid"), F.col("fullname").alias("c_fullname"))
    return h.join(c, h["h_customerid"].eqNullSafe(c["c_customerid"]), "full_outer")


@query
def join_inner(src: FixtureSource) -> DataFrame:
    d = scenarios.landed_detail(src).select("salesorderid", "salesorderdetailid", "orderqty")
    h = scenarios.landed_header(src).select("salesorderid", "customerid",
                                            F.col("orderdate").cast("date").alias("orderdate"))
    return d.join(h, "salesorderid", "inner")


def _order_lines(src: FixtureSource) -> DataFrame:
    d = scenarios.landed_detail(src).select("salesorderid", "salesorderdetailid")
    h = scenarios.landed_header(src).select("salesorderid", "customerid",
                                            F.col("orderdate").cast("date").alias("orderdate"))
    return d.join(h, "salesorderid", "inner")


@query
def dim_lookup_current(src: FixtureSource) -> DataFrame:
    return lookup.dim_lookup(_order_lines(src), scenarios.customer_merged(src), "customerid",
                             "customerid", "customer_key", version="current")


@query
def dim_lookup_all_versions(src: FixtureSource) -> DataFrame:
    return lookup.dim_lookup(_order_lines(src), scenarios.customer_merged(src), "customerid",
                             "customerid", "customer_key", version="all")


@query
def dim_lookup_as_of(src: FixtureSource) -> DataFrame:
    dim = scenarios.customer_merged(src, as_of_dates=True)
    return lookup.dim_lookup(_order_lines(src), dim, "customerid", "customerid", "customer_key",
                             version="as_of", at="orderdate")


@query
def merge_upsert(src: FixtureSource) -> DataFrame:
    # The fact stands in for a stored table: materialize it once, then derive
    # both the target and the corrected source from it.
    fact = materialize(scenarios.current_fact(src))
    # Both sides are already one row per key (reduced by revenue).
    return upsert.merge_upsert(scenarios.upsert_target(fact), scenarios.upsert_source(fact),
                               list(facts.DETAIL_KEY), fixed=True)


# -- 2.4 aggregation -------------------------------------------------------------

@query
def distinct_values(src: FixtureSource) -> DataFrame:
    return lookup.distinct_keys(cdc.live_rows(src("sales_salesorderheader")), "status")


@query
def max_watermark(src: FixtureSource) -> DataFrame:
    return cdc.live_rows(src("sales_salesorderdetail")) \
              .agg(F.max("modifieddate").alias("max_modifieddate"))


@query
def max_surrogate_key(src: FixtureSource) -> DataFrame:
    return scenarios.customer_history(src).agg(
        F.coalesce(F.max(conf.SK_COL), F.lit(0).cast("long")).alias("max_sk"))


# -- 2.5 windows -----------------------------------------------------------------

@query
def surrogate_key_initial(src: FixtureSource) -> DataFrame:
    return keys.assign_surrogate_keys(staging.stg_dim_product(src), "productid") \
               .select("productid", conf.SK_COL)


@query
def surrogate_key_append(src: FixtureSource) -> DataFrame:
    """Batch-2 keys absent from the open history, numbered after its max."""
    history = scenarios.customer_history(src)
    start = keys.max_surrogate_key(history)
    new = scenarios.customer_batch2(src).join(scd2.open_rows(history).select("customerid"),
                                              "customerid", "left_anti")
    return keys.assign_surrogate_keys(new.select("customerid"), "customerid", start=start)


# -- 2.6 set operations ----------------------------------------------------------

@query
def union_by_name(src: FixtureSource) -> DataFrame:
    history = scenarios.customer_history(src)
    opened = scd2.open_rows(history)
    return scd2.closed_rows(history).unionByName(opened.select(*reversed(opened.columns)))


# -- 2.7 scalar functions ----------------------------------------------------------

@query
def fn_full_name(src: FixtureSource) -> DataFrame:
    return cdc.live_rows(src("person_person")).select(
        "businessentityid",
        scalar.full_name("firstname", "middlename", "lastname").alias("fullname"))


def _tracked_rows(src: FixtureSource) -> DataFrame:
    return staging.stg_dim_customer(src)


@query
def fn_row_fingerprint(src: FixtureSource) -> DataFrame:
    return _tracked_rows(src).select("customerid", scalar.row_fingerprint(
        list(CUSTOMER.tracked)).alias("hash_md5"))


@query
def fn_row_fingerprint_safe(src: FixtureSource) -> DataFrame:
    return _tracked_rows(src).select("customerid", scalar.row_fingerprint_safe(
        list(CUSTOMER.tracked)).alias("hash_md5"))


@query
def fn_surrogate_hash(src: FixtureSource) -> DataFrame:
    return src("sales_salesorderheader").select(
        "salesorderid", "creditcardid", "status",
        scalar.surrogate_hash(["salesorderid", "creditcardid", "status"]).alias("row_key"))


@query
def fn_date_format(src: FixtureSource) -> DataFrame:
    return src("sales_salesorderheader").select(
        "salesorderid", scalar.format_date("orderdate").alias("order_day"))


@query
def fn_case_decode(src: FixtureSource) -> DataFrame:
    return src("sales_salesorderheader").select(
        "salesorderid", "status", scalar.decode_order_status("status").alias("order_status_name"))


@query
def fn_cast_date(src: FixtureSource) -> DataFrame:
    return src("sales_salesorderheader").select(
        "salesorderid", scalar.to_date("orderdate").alias("orderdate"))


@query
def fn_revenue(src: FixtureSource) -> DataFrame:
    return src("sales_salesorderdetail").select(
        "salesorderid", "salesorderdetailid",
        scalar.revenue("unitprice", "orderqty").alias("revenue"))


# -- 2.8 composite jobs ----------------------------------------------------------

def _classified(src: FixtureSource) -> DataFrame:
    cls = scd2.scd2_classify(scd2.open_rows(scenarios.customer_history(src)),
                             scenarios.customer_batch2(src), CUSTOMER.key, CUSTOMER.tracked)
    return cls.select(F.col("key").alias("customerid"), "action")


@query
def scd2_classify(src: FixtureSource) -> DataFrame:
    return _classified(src)


@query
def scd2_initial(src: FixtureSource) -> DataFrame:
    return scd2.scd2_initial(staging.stg_dim_customer(src), "customerid",
                             scenarios.FIRST_LOAD_DATE)


@query
def scd2_merge(src: FixtureSource) -> DataFrame:
    return scenarios.customer_merged(src)


def _merge_rows(src: FixtureSource, action: str) -> DataFrame:
    merged = scenarios.customer_merged(src, with_action=True)
    return merged.filter(F.col("action") == F.lit(action)).drop("action")


@query
def scd2_insert(src: FixtureSource) -> DataFrame:
    return _merge_rows(src, conf.INSERT)


@query
def scd2_update(src: FixtureSource) -> DataFrame:
    return _merge_rows(src, conf.UPDATE)


@query
def scd2_delete(src: FixtureSource) -> DataFrame:
    return _merge_rows(src, conf.DELETE)


@query
def scd2_nochange(src: FixtureSource) -> DataFrame:
    return _merge_rows(src, conf.NOCHANGE)


@query
def stg_dim_address(src: FixtureSource) -> DataFrame:
    return staging.stg_dim_address(src)


@query
def stg_dim_credit_card(src: FixtureSource) -> DataFrame:
    return staging.stg_dim_credit_card(src)


@query
def stg_dim_customer(src: FixtureSource) -> DataFrame:
    return staging.stg_dim_customer(src)


@query
def stg_dim_order_status(src: FixtureSource) -> DataFrame:
    return staging.stg_dim_order_status(src)


@query
def stg_dim_product(src: FixtureSource) -> DataFrame:
    return staging.stg_dim_product(src)


@query
def stg_date(src: FixtureSource) -> DataFrame:
    return staging.stg_date(src)


@query
def landing_initial(src: FixtureSource) -> DataFrame:
    return facts.landing_initial(src("sales_salesorderdetail"))


@query
def landing_incremental(src: FixtureSource) -> DataFrame:
    """Target landed up to the cut-off; the increment (any flag) from the
    target's max timestamp is applied by key."""
    detail = src("sales_salesorderdetail")
    cutoff = F.lit(scenarios.LANDING_CUTOFF).cast("timestamp_ntz")
    target = facts.landing_initial(detail.filter(F.col("modifieddate") <= cutoff))
    return facts.landing_incremental(detail, target, facts.DETAIL_KEY)


@query
def landing_versions(src: FixtureSource) -> DataFrame:
    """Versioned landing (daily run): the newest version of every detail key,
    deleted ones included with their flag."""
    return facts.landed_versions(src("sales_salesorderdetail"), facts.DETAIL_KEY)


@query
def sales_fact(src: FixtureSource) -> DataFrame:
    return scenarios.current_fact(src)


@query
def sales_fact_incremental(src: FixtureSource) -> DataFrame:
    rows: dict[str, int] = {}
    dims = scenarios.first_load_dims(src, rows=rows)
    detail, header = scenarios.landed_detail(src), scenarios.landed_header(src)
    # The target is the stored fact of an earlier run: materialized once.
    target = materialize(scenarios.upsert_target(
        facts.sales_fact(detail, header, dims, dim_rows=rows)))
    return facts.sales_fact_incremental(detail, header, dims, target, dim_rows=rows)


@query
def revenue_by_dimension(src: FixtureSource) -> DataFrame:
    """Consumer check on the built star (not an operator of its own)."""
    from starloom.plans.daily_run import revenue_by_dimension as rbd
    rows: dict[str, int] = {}
    # Only what the result uses; after a first load every row is an open one.
    dims = scenarios.first_load_dims(src, rows=rows, names=("dim_product", "dim_address"))
    fact = scenarios.current_fact(src, dims=dims, dim_rows=rows, lookups=("product_key", "ship_address_key"))
    return rbd(fact, dims["dim_product"], dims["dim_address"], rows)


# -- the write side: stored tables, read back --------------------------------------

def _new_root(src: FixtureSource, name: str) -> str:
    return f"{ensure_checkpoint_dir(src.spark).rstrip('/')}/{name}-{publish.new_run_id()}"


@query
def publish_roundtrip(src: FixtureSource) -> DataFrame:
    """A staged table overwritten by its next state."""
    path = _new_root(src, "roundtrip")
    staged = staging.stg_dim_product(src)
    publish.overwrite(staged.filter(F.col("productid") % 2 == 0), path)
    publish.overwrite(staged, path)
    return src.spark.read.schema(staged.schema).parquet(path)


@query
def sink_append(src: FixtureSource) -> DataFrame:
    """A table appended to twice."""
    path = _new_root(src, "append")
    staged = staging.stg_dim_product(src)
    for part in (0, 1):
        publish.append(staged.filter(F.col("productid") % 2 == part), path)
    return src.spark.read.schema(staged.schema).parquet(path)


def _new_table(src: FixtureSource) -> tuple[str, dict[str, str]]:
    run = publish.new_run_id().replace("-", "_")
    return f"sink_{run}", {"path": _new_root(src, "table")}


@query
def sink_truncate_load(src: FixtureSource) -> DataFrame:
    """A catalog table whose rows are replaced; its columns stay."""
    table, options = _new_table(src)
    staged = staging.stg_dim_product(src)
    publish.truncate_load(staged.filter(F.col("productid") % 2 == 0), table, options=options)
    publish.truncate_load(staged.select(*reversed(staged.columns)), table)
    return scan(src.spark, table)


@query
def sink_create_or_replace(src: FixtureSource) -> DataFrame:
    """A catalog table replaced by one of other columns."""
    table, options = _new_table(src)
    publish.create_or_replace(staging.stg_dim_product(src), table, options=options)
    publish.create_or_replace(staging.stg_dim_address(src), table, options=options)
    return scan(src.spark, table)


@query
def target_exists(src: FixtureSource) -> DataFrame:
    """The load that an existing, an empty and a missing target lead to, and whether
    a change set is empty."""
    root = _new_root(src, "targets")
    detail = src("sales_salesorderdetail")
    publish.overwrite(cdc.live_rows(detail), f"{root}/full")
    publish.overwrite(detail.filter(F.col("salesorderid") < 0), f"{root}/empty")
    found = [(name, path_has_data(src.spark, f"{root}/{name}")) for name in ("full", "empty", "missing")]
    late = cdc.after_watermark(detail, "modifieddate", F.lit(scenarios.LANDING_CUTOFF).cast("timestamp_ntz"))
    found += [("changes", not cdc.is_empty(late)), ("no_changes", not cdc.is_empty(late.filter("orderqty < 0")))]
    return src.spark.createDataFrame(found, "target string, has_rows boolean")


@query
def upsert_partitions_months(src: FixtureSource) -> DataFrame:
    """Order headers stored by month (as text), then a corrected month upserted."""
    root = _new_root(src, "months")
    rows = src("sales_salesorderheader").select(
        "salesorderid", "customerid", "status", F.date_format("orderdate", "yyyyMM").alias("month"))
    last = F.lit(scenarios.UPSERT_MONTH)
    publish.upsert_partitions(src.spark, root, rows, "salesorderid", "month")
    publish.upsert_partitions(src.spark, root, rows.filter(F.col("month") == last).withColumn(
        "customerid", -F.col("customerid")), "salesorderid", "month")
    return publish.read_upserted(src.spark, root, rows.schema)


@query
def dimension_two_runs(src: FixtureSource) -> DataFrame:
    """A stored dimension after a first load and a merge, its whole history."""
    root, buckets = _new_root(src, "dimension"), 16
    staged = scenarios.customer_batch2(src)
    dimensions.store_dimension(scenarios.customer_history(src), root, CUSTOMER.key, buckets)
    dimensions.merge_stored_dimension(src.spark, root, CUSTOMER, staged, scenarios.MERGE_LOAD_DATE, buckets)
    return dimensions.read_dimension(src.spark, root, staged.schema)
