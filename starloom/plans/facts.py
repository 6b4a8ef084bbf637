"""Fact tables: watermark landing of order header/detail and the sales fact.

Sales fact plan. Four of the five dimension keys live on the order header,
so those lookups run on the headers (a few rows per order) before the header
meets the detail lines; only the product lookup runs on the lines. A large
dimension (customer, address) therefore shuffles headers, never the fact.
Within each side, lookups run smallest dimension first, so broadcast lookups
precede any that shuffle. Then detail INNER JOIN header on the order id (a
shuffle join of two large inputs; AQE splits a hot order). An incremental
build filters the header on the raw timestamp before anything else, so the
predicate reaches the parquet scan and the filtered header side can be
broadcast to the detail scan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import conf
from starloom.functions.scalar import revenue, surrogate_hash
from starloom.operators.cdc import (after_watermark, live_rows, max_value,
                                    newest_per_key)
from starloom.operators.columns import drop_metadata
from starloom.operators.lookup import checked_sides, dim_side, join_side
from starloom.operators.upsert import apply_changes, merge_upsert
from starloom.sources.bucketed import BucketedOrders, hot_headers

DETAIL_KEY = ("salesorderid", "salesorderdetailid")
HEADER_KEY = ("salesorderid",)

# (dimension, natural key on the header, dimension natural key, fact column),
# smallest dimension first.
HEADER_LOOKUPS = (
    ("dim_orderstatus", "order_status", "order_status", "order_status_key"),
    ("dim_creditcard", "creditcardid", "creditcardid", "creditcard_key"),
    ("dim_address", "shiptoaddressid", "addressid", "ship_address_key"),
    ("dim_customer", "customerid", "customerid", "customer_key"),
)
# The same for the detail lines.
DETAIL_LOOKUPS = (
    ("dim_product", "productid", "productid", "product_key"),
)
# The fact's columns.
FACT_SCHEMA = ("sales_key string, product_key long, customer_key long, ship_address_key long, order_status_key long, "
               "creditcard_key long, salesorderid long, salesorderdetailid long, unitprice decimal(12,2), orderqty int, "
               "orderdate date, revenue decimal(18,2)")
FACT_COLUMNS = tuple(c.split()[0] for c in FACT_SCHEMA.split(", "))


# -- landing ------------------------------------------------------------------

def landing_initial(source: DataFrame, flag: str = conf.DELETED_FLAG) -> DataFrame:
    """First load: live rows, ingestion metadata dropped."""
    return drop_metadata(live_rows(source, flag))


def landing_increment(source: DataFrame, ts_col: str, watermark, strict: bool = False) -> DataFrame:
    """Source rows changed since the watermark, any flag (deletes included)."""
    return after_watermark(source, ts_col, watermark, strict)


def landing_incremental(source: DataFrame, target: DataFrame, keys: Sequence[str],
                        ts_col: str = "modifieddate", watermark=None, strict: bool = False,
                        flag: str = conf.DELETED_FLAG) -> DataFrame:
    """Incremental load: rows at or after the watermark (``>=`` unless
    ``strict``) are applied by key: the newest change per key wins, deletes
    remove the key, changed rows replace their old version (no duplicates).
    The watermark defaults to the target's max ``ts_col``."""
    if watermark is None:
        watermark = max_value(target, ts_col)
    increment = landing_increment(source, ts_col, watermark, strict)
    return apply_changes(target, increment, list(keys), [ts_col], flag)


def landed_versions(changes: DataFrame, keys: Sequence[str],
                    ts_col: str = "modifieddate") -> DataFrame:
    """Newest version of every key in a change set, delete flag kept: the
    record a versioned landed table stores (deletes replace, never remove)."""
    return newest_per_key(changes, list(keys), [ts_col])


def live_view(landed: DataFrame, flag: str = conf.DELETED_FLAG,
              extra: Sequence[str] = ()) -> DataFrame:
    """Live rows of a versioned landed table, metadata dropped."""
    return drop_metadata(live_rows(landed, flag)).drop(*extra)


# -- sales fact -----------------------------------------------------------------

def _header(header: DataFrame, since: _dt.date | None, strict: bool) -> DataFrame:
    if since is not None:
        start = since + _dt.timedelta(days=1) if strict else since
        # cast(orderdate as date) >= d  <=>  orderdate >= timestamp(d): pushes down.
        stamp = _dt.datetime.combine(start, _dt.time()).isoformat(sep=" ")
        header = header.filter(F.col("orderdate") >= F.lit(stamp).cast("timestamp_ntz"))
    return header.select("salesorderid", "customerid", "creditcardid", "shiptoaddressid",
                         F.col("status").alias("order_status"),
                         F.col("orderdate").cast("date").alias("orderdate"))


def sales_fact(detail: DataFrame, header: DataFrame, dims: Mapping[str, DataFrame],
               version: str = "current", since: _dt.date | None = None,
               strict: bool = False, broadcast: bool | str = True,
               dim_rows: Mapping[str, int] | None = None, colocated: bool = False,
               lookups: Sequence[str] | None = None) -> DataFrame:
    """Star-schema sales fact from landed detail and header rows.

    ``version`` picks the dimension row per natural key: ``current`` (open
    row), ``as_of`` (valid on the order date) or ``all`` (every version;
    one fact row per version). ``since`` keeps orders dated on/after it
    (after it when ``strict``). ``broadcast=True`` (default) broadcasts each
    dimension side whose row count is under the configured bound and which has room
    in the driver's heap beside the others, and shuffle-joins the rest; ``"auto"``
    leaves it to the planner.
    ``dim_rows`` gives known upper bounds of the dimensions' open rows: with
    ``version="current"`` those decide the broadcast without a counting job
    (other versions read closed rows too and are counted). ``colocated`` says that
    both inputs are stored in the same buckets of the order id: lines then meet
    headers by a merge join, which needs no shuffle (see
    :func:`sales_fact_bucketed`). ``lookups``, when given, names the dimension keys
    that the caller uses; the others are left out of the result, their dimensions
    are not needed."""
    header_lookups, detail_lookups = (
        [lk for lk in side if lookups is None or lk[3] in lookups] for side in (HEADER_LOOKUPS, DETAIL_LOOKUPS))
    # Prepare the five lookup sides. Those broadcast are in the driver together: the lines'
    # side comes first, whose shuffle would move most rows, then the headers', smallest first.
    sides = {out_col: dim_side(dims[dim_name], dim_key, out_col, version)
             for dim_name, _, dim_key, out_col in detail_lookups + header_lookups}
    known = {out_col: (dim_rows or {}).get(dim_name) if version == "current" else None
             for dim_name, _, _, out_col in detail_lookups + header_lookups}
    sides = checked_sides(sides, broadcast, known)
    h = _header(header, since, strict)
    for _, left_key, _, out_col in header_lookups:
        h = join_side(h, sides[out_col], left_key, at="orderdate")
    h = h.select("salesorderid", "orderdate", *[lk[3] for lk in header_lookups])
    if colocated:
        h = h.hint("merge")
    d = detail.select("salesorderid", "salesorderdetailid", "productid", "orderqty", "unitprice")
    if version == "as_of":
        # The as-of date of a line is its order's date: lines meet headers first.
        fact = d.join(h, "salesorderid", "inner")
        for _, left_key, _, out_col in detail_lookups:
            fact = join_side(fact, sides[out_col], left_key, at="orderdate")
    else:
        for _, left_key, _, out_col in detail_lookups:
            d = join_side(d, sides[out_col], left_key)
        fact = d.join(h, "salesorderid", "inner")
    # Made behind the join, whose shuffle carries neither.
    fact = fact.withColumn("revenue", revenue("unitprice", "orderqty"))
    return fact.select(surrogate_hash(list(DETAIL_KEY)).alias("sales_key"),
                       *[c for c in FACT_COLUMNS[1:] if c in fact.columns])


def sales_fact_bucketed(orders: BucketedOrders, dims: Mapping[str, DataFrame], version: str = "current",
                        dim_rows: Mapping[str, int] | None = None) -> DataFrame:
    """The sales fact from order tables stored in buckets of the order id: neither
    lines nor headers are shuffled for their join (a dimension too large to
    broadcast still shuffles headers). Hot orders meet their headers by broadcast."""
    fact = sales_fact(orders.lines, orders.headers, dims, version, dim_rows=dim_rows, colocated=True)
    if not orders.n_hot:
        return fact
    return fact.unionByName(sales_fact(orders.hot_lines, hot_headers(orders), dims, version, dim_rows=dim_rows))


def reduce_fact_keys(fact: DataFrame) -> DataFrame:
    """One row per sales key (of order id and detail id, two whole numbers, which are
    what is grouped by): the greatest revenue, other columns break ties. An
    aggregate, so it combines map-side before the shuffle."""
    return newest_per_key(fact, list(DETAIL_KEY), ["revenue"])


def order_watermark(detail: DataFrame, header: DataFrame, until: _dt.date | str) -> _dt.date | None:
    """The last order date up to ``until`` that a fact of these tables has, without
    building it: two columns of each table."""
    dated = _header(header, None, False).select("salesorderid", "orderdate")
    dated = dated.filter(F.col("orderdate") <= F.lit(str(until)).cast("date"))
    return max_value(dated.join(detail.select("salesorderid"), "salesorderid", "left_semi"), "orderdate")


def fact_increment_filter(fact: DataFrame, target: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of ``fact`` past the target's max order date (strict ``>`` is
    the faithful form). An empty target means every row."""
    watermark = max_value(target, "orderdate")
    return after_watermark(fact, "orderdate", watermark, strict)


def sales_fact_incremental(detail: DataFrame, header: DataFrame, dims: Mapping[str, DataFrame],
                           target: DataFrame | None, strict: bool = False,
                           version: str = "current",
                           dim_rows: Mapping[str, int] | None = None) -> DataFrame:
    """Incremental sales fact: rebuild the orders dated on/after the target's
    max order date and upsert them by ``sales_key``. No target (or an empty
    one) means a full build; either way the result holds one row per
    ``sales_key`` (the model's unique key)."""
    since = max_value(target, "orderdate") if target is not None else None
    fresh = sales_fact(detail, header, dims, version=version, since=since, strict=strict,
                       dim_rows=dim_rows)
    if target is None or since is None:
        return reduce_fact_keys(fresh)
    return merge_upsert(target, fresh, list(DETAIL_KEY), order_cols=["revenue"])
