"""Replayable load scenarios over the shared test tables: two SCD2 batches
of the customer dimension, first-load dimensions, landed facts and an
upsert. Every frame is derived by Spark from the source tables, so its work
grows with them. Dates are fixed so runs are replayable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import conf
from starloom.functions.scalar import date_literal, revenue
from starloom.operators.keys import assign_surrogate_keys
from starloom.operators.scd2 import scd2_initial, scd2_merge
from starloom.plans.dimensions import DIMENSION_BY_NAME
from starloom.plans.facts import landing_initial, reduce_fact_keys, sales_fact
from starloom.session import run_concurrently
from starloom.plans.staging import (stg_dim_address, stg_dim_credit_card, stg_dim_customer,
                                    stg_dim_order_status, stg_dim_product)
from starloom.sources.tables import SourceReader

# Fixed scenario dates.
FIRST_LOAD_DATE = "2024-01-01"
CLOSED_EXPIRATION = "2024-01-15"
MERGE_LOAD_DATE = "2024-02-01"
# Same scenario placed inside the order-date range, for as-of lookups.
ASOF_FIRST_LOAD = "1995-01-01"
ASOF_CLOSED_EXPIRATION = "1996-01-15"
ASOF_MERGE_LOAD = "1998-06-01"
# Fact split points.
UPSERT_TARGET_END = "2001-06-30"
UPSERT_SOURCE_START = "2001-06-01"
UPSERT_MONTH = "200106"
LANDING_CUTOFF = "2001-06-30 00:00:00"

CUSTOMER = DIMENSION_BY_NAME["dim_customer"]


def customer_batch1(read: SourceReader) -> DataFrame:
    return stg_dim_customer(read).filter(F.col("customerid") % 19 != 0)


def customer_batch2(read: SourceReader) -> DataFrame:
    stg = stg_dim_customer(read).filter(F.col("customerid") % 11 != 0)
    changed = F.col("customerid") % 7 == 0
    # A NULL name changes too: NULL + suffix is the bare suffix.
    suffixed = F.concat(F.coalesce(F.col("fullname"), F.lit("")), F.lit("_v2"))
    return stg.withColumn("fullname", F.when(changed, suffixed)
                                       .otherwise(F.col("fullname")))


def customer_history(read: SourceReader, effective: str = FIRST_LOAD_DATE,
                     closed_expiration: str = CLOSED_EXPIRATION) -> DataFrame:
    """Batch 1 keyed in customer order; keys % 31 = 5 are already closed."""
    b1 = customer_batch1(read)
    closed = F.col("customerid") % 31 == 5
    keyed = assign_surrogate_keys(b1, "customerid")
    return keyed.withColumns({
        conf.EFFECTIVE_COL: date_literal(effective),
        conf.EXPIRATION_COL: F.when(closed, date_literal(closed_expiration))
                              .otherwise(date_literal(conf.OPEN_END_DATE)),
        conf.CURRENT_COL: ~closed,
    }).select(*b1.columns, *conf.SCD2_COLUMNS)


def customer_merged(read: SourceReader, with_action: bool = False, as_of_dates: bool = False,
                    fingerprint: str = "safe", stats: dict | None = None) -> DataFrame:
    if as_of_dates:
        history = customer_history(read, ASOF_FIRST_LOAD, ASOF_CLOSED_EXPIRATION)
        load = ASOF_MERGE_LOAD
    else:
        history = customer_history(read)
        load = MERGE_LOAD_DATE
    return scd2_merge(history, customer_batch2(read), CUSTOMER.key, CUSTOMER.tracked, load,
                      fingerprint=fingerprint, with_action=with_action, stats=stats)


def first_load_dims(read: SourceReader, load_date: str = FIRST_LOAD_DATE,
                    rows: dict[str, int] | None = None, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Address, card, status and product from a first load; customer after
    the two-batch merge; or only those of ``names``. ``rows`` (a dict) receives the
    open-row counts the loads found while checking their keys."""
    stats: dict[str, dict] = {n: {} for n in ("dim_address", "dim_creditcard",
                                              "dim_orderstatus", "dim_product", "dim_customer")}
    builds = {
        "dim_address": lambda: scd2_initial(stg_dim_address(read), "addressid", load_date,
                                            stats=stats["dim_address"]),
        "dim_creditcard": lambda: scd2_initial(stg_dim_credit_card(read), "creditcardid",
                                               load_date, stats=stats["dim_creditcard"]),
        "dim_orderstatus": lambda: scd2_initial(stg_dim_order_status(read), "order_status",
                                                load_date, stats=stats["dim_orderstatus"]),
        "dim_product": lambda: scd2_initial(stg_dim_product(read), "productid", load_date,
                                            stats=stats["dim_product"]),
        "dim_customer": lambda: customer_merged(read, stats=stats["dim_customer"]),
    }
    dims = run_concurrently({name: build for name, build in builds.items() if names is None or name in names})
    if rows is not None:
        rows.update({n: s["rows"] for n, s in stats.items() if "rows" in s})
    return dims


def landed_detail(read: SourceReader) -> DataFrame:
    return landing_initial(read("sales_salesorderdetail"))


def landed_header(read: SourceReader) -> DataFrame:
    return landing_initial(read("sales_salesorderheader"))


def current_fact(read: SourceReader, version: str = "current",
                 dims: dict[str, DataFrame] | None = None,
                 dim_rows: dict[str, int] | None = None, **options) -> DataFrame:
    if dims is None:
        dim_rows = {}
        dims = first_load_dims(read, rows=dim_rows)
    return sales_fact(landed_detail(read), landed_header(read), dims, version=version,
                      dim_rows=dim_rows, **options)


def upsert_target(fact: DataFrame) -> DataFrame:
    return reduce_fact_keys(fact.filter(F.col("orderdate") <= F.lit(UPSERT_TARGET_END).cast("date")))


def upsert_source(fact: DataFrame) -> DataFrame:
    """Orders after the source start with a corrected unit price."""
    src = fact.filter(F.col("orderdate") > F.lit(UPSERT_SOURCE_START).cast("date"))
    src = src.withColumn("unitprice", (F.col("unitprice") + 1).cast("decimal(12,2)"))
    src = src.withColumn("revenue", revenue("unitprice", "orderqty"))
    return reduce_fact_keys(src)
