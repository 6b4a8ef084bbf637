"""DuckDB SQL for every registered query (same names, same output columns).

Base tables (region nation customer supplier part orders lineitem ...) are
views in the checking database; the operational source views and the staged
tables are supplied as CTEs, each pulled in with its dependencies.
Conventions shared with the Spark side: keys bigint, sums decimal(18,2),
windows order NULLS FIRST, fixed dates instead of current_date.
"""

from __future__ import annotations

import re

from starloom import conf
from starloom.plans import scenarios as sc

NULL_SK = conf.SURROGATE_NULL
OPEN = conf.OPEN_END_DATE


def fp_safe(cols: list[str]) -> str:
    parts = [f"coalesce(cast(length(cast({c} as varchar)) as varchar) || ':' || cast({c} as varchar), "
             f"'{conf.FINGERPRINT_NULL}')" for c in cols]
    return f"md5(concat_ws('', {', '.join(parts)}))"


def fp_plain(cols: list[str]) -> str:
    return f"md5(concat_ws('', {', '.join(f'cast({c} as varchar)' for c in cols)}))"


def sk_hash(cols: list[str]) -> str:
    parts = [f"coalesce(cast({c} as varchar), '{NULL_SK}')" for c in cols]
    return f"md5(concat_ws('{conf.SURROGATE_SEPARATOR}', {', '.join(parts)}))"


def _status_case(c: str) -> str:
    whens = " ".join(f"when {c} = {k} then '{v}'" for k, v in conf.ORDER_STATUS_NAMES.items())
    return f"case {whens} else '{conf.ORDER_STATUS_DEFAULT}' end"


TRACKED = list(sc.CUSTOMER.tracked)
CUST_COLS = ["customerid", "businessentityid", "fullname", "storebusinessentityid", "storename"]
SCD_COLS = ["sk_id", "effective_date", "expiration_date", "current_flag"]

VIEWS: dict[str, str] = {
    # -- operational sources ---------------------------------------------------
    "person_address": "select c_custkey as addressid, concat('City_', c_mktsegment) as city, case when c_custkey % 10 = 9 then null else c_nationkey end as stateprovinceid, case when c_custkey % 13 = 0 then true when c_custkey % 17 = 0 then null else false end as _deleted from customer",
    "person_stateprovince": "select n_nationkey as stateprovinceid, n_name as name, case when n_nationkey = 7 then null else concat('R', cast(n_regionkey as varchar(9))) end as countryregioncode, n_nationkey % 6 = 5 as _deleted from nation",
    "person_countryregion": "select concat('R', cast(r_regionkey as varchar(9))) as countryregioncode, r_name as name, r_regionkey = 4 as _deleted from region",
    "production_product": "select p_partkey as productid, p_name as name, concat('PN-', cast(p_partkey as varchar(20))) as productnumber, case when p_partkey % 8 = 3 then null else split_part(p_name, ' ', 1) end as color, case when p_partkey % 9 = 0 then null else p_size end as productsubcategoryid, case when p_partkey % 13 = 0 then true when p_partkey % 17 = 0 then null else false end as _deleted from part",
    "production_productsubcategory": "select distinct p_size as productsubcategoryid, concat('Sub_', cast(p_size as varchar(9))) as name, p_size % 7 as productcategoryid, p_size % 10 = 3 as _deleted from part",
    "production_productcategory": "select distinct p_size % 7 as productcategoryid, concat('Cat_', cast(p_size % 7 as varchar(9))) as name, p_size % 7 = 2 as _deleted from part where p_size % 7 < 6",
    "sales_customer": "select c_custkey as customerid, case when c_custkey % 4 <> 0 then c_custkey + 100000 end as personid, case when c_custkey % 3 = 0 then c_custkey // 15 end as storeid, case when c_custkey % 13 = 0 then true when c_custkey % 17 = 0 then null else false end as _deleted from customer",
    "person_person": "select c_custkey + 100000 as businessentityid, case when c_custkey % 50 = 1 then null else c_name end as firstname, case when c_custkey % 2 = 0 then 'M' end as middlename, case when c_custkey % 50 = 1 then null else c_mktsegment end as lastname, c_custkey % 29 = 0 as _deleted from customer",
    "sales_store": "select s_suppkey as businessentityid, s_name as name, s_suppkey % 7 = 6 as _deleted from supplier",
    "sales_salesorderheader": "select o_orderkey as salesorderid, o_custkey as customerid, case when o_orderkey % 5 <> 0 then o_custkey end as creditcardid, o_custkey as shiptoaddressid, case when o_orderkey % 40 = 39 then null else cast(o_orderkey % 8 as int) end as status, o_orderdate as orderdate, o_orderdate as modifieddate, case when o_orderkey % 13 = 0 then true when o_orderkey % 17 = 0 then null else false end as _deleted from orders",
    "sales_salesorderdetail": "select l_orderkey as salesorderid, l_partkey * 100000 + l_suppkey * 10 + l_linenumber as salesorderdetailid, l_partkey as productid, cast(l_quantity as int) as orderqty, cast(l_extendedprice as decimal(12,2)) as unitprice, l_shipdate as modifieddate, case when l_orderkey % 13 = 0 then true when l_orderkey % 17 = 0 then null else false end as _deleted from lineitem",
    "sales_creditcard": "select p_partkey as creditcardid, p_type as cardtype, p_partkey % 23 = 0 as _deleted from part",
    "date_src": "select d as date_day, cast(d - interval '1' day as date) as prior_date_day, cast(d + interval '1' day as date) as next_date_day, cast(d - interval '12' month as date) as prior_year_date_day, cast(d - interval '364' day as date) as prior_year_over_year_date_day, cast(extract(doy from d) as int) as day_of_year, cast(extract(day from d) as int) as day_of_month, cast((datediff('day', date '1995-01-01', d)) % 7 + 1 as int) as day_of_week, case (datediff('day', date '1995-01-01', d)) % 7 when 0 then 'Sunday' when 1 then 'Monday' when 2 then 'Tuesday' when 3 then 'Wednesday' when 4 then 'Thursday' when 5 then 'Friday' else 'Saturday' end as day_of_week_name, extract(day from d) = 31 as _deleted from (select distinct cast(o_orderdate as date) as d from orders) x",
    # -- staging -----------------------------------------------------------------
    "stg_dim_address": """select a.addressid, a.city as city_name, s.name as state_name, c.name as country_name
        from (select * from person_address where _deleted = false) a
        left join (select * from person_stateprovince where _deleted = false) s on a.stateprovinceid = s.stateprovinceid
        left join (select * from person_countryregion where _deleted = false) c on s.countryregioncode = c.countryregioncode""",
    "stg_dim_credit_card": """select u.creditcardid, c.cardtype
        from (select distinct creditcardid from sales_salesorderheader where creditcardid is not null and _deleted = false) u
        left join (select * from sales_creditcard where _deleted = false) c on u.creditcardid = c.creditcardid""",
    "stg_dim_customer": """select c.customerid, p.businessentityid, p.fullname, s.storebusinessentityid, s.name as storename
        from (select customerid, personid, storeid from sales_customer where _deleted = false) c
        left join (select businessentityid, concat_ws(' ', firstname, middlename, lastname) as fullname from person_person where _deleted = false) p on c.personid = p.businessentityid
        left join (select businessentityid as storebusinessentityid, name from sales_store where _deleted = false) s on c.storeid = s.storebusinessentityid""",
    "stg_dim_order_status": f"""select order_status, {_status_case('order_status')} as order_status_name
        from (select distinct status as order_status from sales_salesorderheader where _deleted = false) x""",
    "stg_dim_product": """select p.productid, p.name as product_name, p.productnumber, p.color, s.name as product_subcategory_name, c.name as product_category_name
        from (select * from production_product where _deleted = false) p
        left join (select * from production_productsubcategory where _deleted = false) s on p.productsubcategoryid = s.productsubcategoryid
        left join (select * from production_productcategory where _deleted = false) c on s.productcategoryid = c.productcategoryid""",
    "stg_date": "select date_day, prior_date_day, next_date_day, prior_year_date_day, prior_year_over_year_date_day, day_of_year, day_of_month, day_of_week, day_of_week_name from date_src where _deleted = false",
    # -- landed facts ----------------------------------------------------------------
    "landed_detail": "select salesorderid, salesorderdetailid, productid, orderqty, unitprice, modifieddate from sales_salesorderdetail where _deleted = false",
    "landed_header": "select salesorderid, customerid, creditcardid, shiptoaddressid, status, orderdate, modifieddate from sales_salesorderheader where _deleted = false",
}


def _first_load(name: str, stg: str, key: str, load: str) -> str:
    return (f"select *, cast(row_number() over (order by {key} nulls first) as bigint) as sk_id, "
            f"date '{load}' as effective_date, date '{OPEN}' as expiration_date, true as current_flag "
            f"from {stg}")


for _dim, _stg, _key in (("dim_address", "stg_dim_address", "addressid"),
                         ("dim_creditcard", "stg_dim_credit_card", "creditcardid"),
                         ("dim_orderstatus", "stg_dim_order_status", "order_status"),
                         ("dim_product", "stg_dim_product", "productid")):
    VIEWS[_dim] = _first_load(_dim, _stg, _key, sc.FIRST_LOAD_DATE)


def _customer_views(suffix: str, eff: str, closed_exp: str, load: str, fp=fp_safe) -> None:
    hist, b2, cls, merged = (f"customer_history{suffix}", f"customer_batch2",
                             f"customer_classified{suffix}", f"customer_merged{suffix}")
    VIEWS["customer_batch1"] = "select * from stg_dim_customer where customerid % 19 <> 0"
    VIEWS["customer_batch2"] = ("select customerid, businessentityid, case when customerid % 7 = 0 "
                                "then coalesce(fullname, '') || '_v2' else fullname end as fullname, "
                                "storebusinessentityid, storename from stg_dim_customer "
                                "where customerid % 11 <> 0")
    VIEWS[hist] = (f"select {', '.join(CUST_COLS)}, "
                   f"cast(row_number() over (order by customerid nulls first) as bigint) as sk_id, "
                   f"date '{eff}' as effective_date, case when customerid % 31 = 5 then date '{closed_exp}' "
                   f"else date '{OPEN}' end as expiration_date, customerid % 31 <> 5 as current_flag "
                   f"from customer_batch1")
    h_cols = ", ".join(f"h.{c} as h_{c}" for c in CUST_COLS + SCD_COLS)
    c_cols = ", ".join(f"c.{c} as c_{c}" for c in CUST_COLS)
    VIEWS[cls] = f"""select {h_cols}, {c_cols}, coalesce(h.customerid, c.customerid) as key,
          case when h.in_h and c.in_c and h.fp = c.fp then 'NOCHANGE'
               when c.in_c is null then 'DELETE' when h.in_h is null then 'INSERT' else 'UPDATE' end as action
        from (select *, true as in_h, {fp(TRACKED)} as fp from {hist} where current_flag = true) h
        full outer join (select *, true as in_c, {fp(TRACKED)} as fp from {b2}) c
          on h.customerid is not distinct from c.customerid"""
    hc = ", ".join(f"h_{c} as {c}" for c in CUST_COLS)
    cc = ", ".join(f"c_{c} as {c}" for c in CUST_COLS)
    VIEWS[merged] = f"""select {', '.join(CUST_COLS + SCD_COLS)}, cast(null as varchar) as action
          from {hist} where not coalesce(current_flag = true, false)
        union all
        select {hc}, h_sk_id as sk_id, h_effective_date as effective_date,
          case when action = 'NOCHANGE' then h_expiration_date else date '{load}' end as expiration_date,
          case when action = 'NOCHANGE' then h_current_flag else false end as current_flag, action
          from {cls} where action in ('NOCHANGE', 'DELETE', 'UPDATE')
        union all
        select {cc}, cast((select coalesce(max(sk_id), 0) from {hist}) + row_number() over (
            order by case when action = 'INSERT' then 0 else 1 end, c_customerid nulls first) as bigint) as sk_id,
          date '{load}' as effective_date, date '{OPEN}' as expiration_date, true as current_flag, action
          from {cls} where action in ('INSERT', 'UPDATE')"""


_customer_views("", sc.FIRST_LOAD_DATE, sc.CLOSED_EXPIRATION, sc.MERGE_LOAD_DATE)
_customer_views("_asof", sc.ASOF_FIRST_LOAD, sc.ASOF_CLOSED_EXPIRATION, sc.ASOF_MERGE_LOAD)
VIEWS["dim_customer"] = f"select {', '.join(CUST_COLS + SCD_COLS)} from customer_merged"

_FACT_SELECT = f"""select {sk_hash(['d.salesorderid', 'd.salesorderdetailid'])} as sales_key,
      p.sk_id as product_key, c.sk_id as customer_key, a.sk_id as ship_address_key,
      os.sk_id as order_status_key, cc.sk_id as creditcard_key, d.salesorderid, d.salesorderdetailid,
      d.unitprice, d.orderqty, h.orderdate, d.revenue
    from (select salesorderid, salesorderdetailid, productid, orderqty, unitprice,
            cast(unitprice * orderqty as decimal(18,2)) as revenue from landed_detail) d
    join (select salesorderid, customerid, creditcardid, shiptoaddressid, status as order_status,
            cast(orderdate as date) as orderdate from landed_header) h on d.salesorderid = h.salesorderid
    left join (select * from dim_customer where current_flag = true) c on h.customerid = c.customerid
    left join (select * from dim_address where current_flag = true) a on h.shiptoaddressid = a.addressid
    left join (select * from dim_orderstatus where current_flag = true) os on h.order_status = os.order_status
    left join (select * from dim_creditcard where current_flag = true) cc on h.creditcardid = cc.creditcardid
    left join (select * from dim_product where current_flag = true) p on d.productid = p.productid"""
VIEWS["sales_fact"] = _FACT_SELECT

FACT_COLS = ["sales_key", "product_key", "customer_key", "ship_address_key", "order_status_key",
             "creditcard_key", "salesorderid", "salesorderdetailid", "unitprice", "orderqty",
             "orderdate", "revenue"]
_FACT_TIE = ", ".join(f"{c} desc nulls last" for c in ["revenue"] + [c for c in FACT_COLS
                                                                     if c not in ("sales_key", "revenue")])


def _reduce(body: str) -> str:
    return (f"select {', '.join(FACT_COLS)} from (select *, row_number() over (partition by sales_key "
            f"order by {_FACT_TIE}) as _rn from ({body}) x) y where _rn = 1")


VIEWS["upsert_target"] = _reduce(f"select * from sales_fact where orderdate <= date '{sc.UPSERT_TARGET_END}'")
VIEWS["upsert_source"] = _reduce(
    f"select sales_key, product_key, customer_key, ship_address_key, order_status_key, creditcard_key, "
    f"salesorderid, salesorderdetailid, cast(unitprice + 1 as decimal(12,2)) as unitprice, orderqty, orderdate, "
    f"cast(cast(unitprice + 1 as decimal(12,2)) * orderqty as decimal(18,2)) as revenue "
    f"from sales_fact where orderdate > date '{sc.UPSERT_SOURCE_START}'")

_DEPS_CACHE: dict[str, list[str]] = {}


def _deps(name: str) -> list[str]:
    if name not in _DEPS_CACHE:
        body = VIEWS[name]
        _DEPS_CACHE[name] = [v for v in VIEWS if v != name and re.search(rf"\b{v}\b", body)]
    return _DEPS_CACHE[name]


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs it references, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for d in _deps(name):
            visit(d)
        order.append(name)

    for v in VIEWS:
        if re.search(rf"\b{v}\b", sql):
            visit(v)
    if not order:
        return sql
    ctes = ",\n".join(f"{v} as ({VIEWS[v]})" for v in order)
    return f"with {ctes}\n{sql}"


def _merge_rows(action: str) -> str:
    return (f"select {', '.join(CUST_COLS + SCD_COLS)} from customer_merged "
            f"where action = '{action}'")


_ORDER_LINES = """select d.salesorderid, d.salesorderdetailid, h.customerid, cast(h.orderdate as date) as orderdate
    from landed_detail d join landed_header h on d.salesorderid = h.salesorderid"""

_RAW: dict[str, str] = {
    "src_scan": "select * from sales_salesorderheader",
    "src_parquet_scan": "select l_orderkey as salesorderid, l_linenumber as linenumber, l_shipdate as modifieddate from lineitem",
    "drop_metadata": "select salesorderid, salesorderdetailid, productid, orderqty, unitprice, modifieddate from sales_salesorderdetail",
    "load_metrics": " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}"
        for t in ("stg_dim_address", "stg_dim_credit_card", "stg_dim_customer",
                  "stg_dim_order_status", "stg_dim_product", "stg_date")),
    "filter_soft_delete": "select * from sales_customer where _deleted = false",
    "filter_not_null": "select salesorderid, creditcardid from sales_salesorderheader where creditcardid is not null",
    "watermark_increment": f"select * from sales_salesorderdetail where modifieddate > timestamp '{sc.LANDING_CUTOFF}'",
    "fact_incremental_filter": f"""select * from sales_fact where orderdate > (
        select max(orderdate) from sales_fact where orderdate <= date '{sc.UPSERT_TARGET_END}')""",
    "scd2_open_rows": "select * from customer_history where current_flag = true",
    "scd2_closed_rows": "select * from customer_history where current_flag = false",
    "scd2_changes_only": "select key as customerid, action from customer_classified where action <> 'NOCHANGE'",
    "project_alias": "select salesorderid, customerid, status as order_status, shiptoaddressid as ship_to from sales_salesorderheader",
    "conform_columns": f"""select {', '.join(CUST_COLS)}, cast(0 as bigint) as sk_id, date '{sc.MERGE_LOAD_DATE}' as effective_date,
        date '{OPEN}' as expiration_date, true as current_flag from stg_dim_customer""",
    "rename_suffix": "select creditcardid as creditcardid_current, cardtype as cardtype_current from stg_dim_credit_card",
    "dim_date": f"""select {sk_hash(['date_day'])} as date_key, prior_year_over_year_date_day, next_date_day, day_of_year,
        date_day, day_of_month, prior_date_day, day_of_week, day_of_week_name, prior_year_date_day from stg_date""",
    "join_left_chain": """select a.addressid, a.stateprovinceid, s.countryregioncode, s.name as state_name, c.name as country_name
        from (select * from person_address where _deleted = false) a
        left join (select * from person_stateprovince where _deleted = false) s on a.stateprovinceid = s.stateprovinceid
        left join (select * from person_countryregion where _deleted = false) c on s.countryregioncode = c.countryregioncode""",
    "join_left_star": """select c.customerid, c.personid, c.storeid, p.lastname, s.name as storename
        from (select * from sales_customer where _deleted = false) c
        left join (select * from person_person where _deleted = false) p on c.personid = p.businessentityid
        left join (select * from sales_store where _deleted = false) s on c.storeid = s.businessentityid""",
    "join_distinct_left": """select u.creditcardid, c.cardtype, c._deleted as card_deleted
        from (select distinct creditcardid from sales_salesorderheader where _deleted = false) u
        left join sales_creditcard c on u.creditcardid = c.creditcardid""",
    "join_full_outer": """select h.customerid as h_customerid, h.fullname as h_fullname, c.customerid as c_customerid, c.fullname as c_fullname
        from (select * from customer_history where current_flag = true) h
        full outer join customer_batch2 c on h.customerid is not distinct from c.customerid""",
    "join_inner": """select d.salesorderid, d.salesorderdetailid, d.orderqty, h.customerid, cast(h.orderdate as date) as orderdate
        from landed_detail d join landed_header h on d.salesorderid = h.salesorderid""",
    "dim_lookup_current": f"""select o.*, c.sk_id as customer_key from ({_ORDER_LINES}) o
        left join (select * from customer_merged where current_flag = true) c on o.customerid = c.customerid""",
    "dim_lookup_all_versions": f"""select o.*, c.sk_id as customer_key from ({_ORDER_LINES}) o
        left join customer_merged c on o.customerid = c.customerid""",
    "dim_lookup_as_of": f"""select o.*, c.sk_id as customer_key from ({_ORDER_LINES}) o
        left join customer_merged_asof c on o.customerid = c.customerid
          and o.orderdate >= c.effective_date and o.orderdate < c.expiration_date""",
    "merge_upsert": f"""select {', '.join(FACT_COLS)} from upsert_target t
          where not exists (select 1 from upsert_source s where s.sales_key = t.sales_key)
        union all select {', '.join(FACT_COLS)} from upsert_source""",
    "distinct_values": "select distinct status from sales_salesorderheader where _deleted = false",
    "max_watermark": "select max(modifieddate) as max_modifieddate from sales_salesorderdetail where _deleted = false",
    "max_surrogate_key": "select coalesce(max(sk_id), 0) as max_sk from customer_history",
    "surrogate_key_initial": "select productid, cast(row_number() over (order by productid nulls first) as bigint) as sk_id from stg_dim_product",
    "surrogate_key_append": """select customerid, cast((select coalesce(max(sk_id), 0) from customer_history)
          + row_number() over (order by customerid nulls first) as bigint) as sk_id
        from customer_batch2 b where not exists (
          select 1 from customer_history h where h.current_flag = true and h.customerid = b.customerid)""",
    "union_by_name": "select * from customer_history",
    "fn_full_name": "select businessentityid, concat_ws(' ', firstname, middlename, lastname) as fullname from person_person where _deleted = false",
    "fn_row_fingerprint": f"select customerid, {fp_plain(TRACKED)} as hash_md5 from stg_dim_customer",
    "fn_row_fingerprint_safe": f"select customerid, {fp_safe(TRACKED)} as hash_md5 from stg_dim_customer",
    "fn_surrogate_hash": f"select salesorderid, creditcardid, status, {sk_hash(['salesorderid', 'creditcardid', 'status'])} as row_key from sales_salesorderheader",
    "fn_date_format": "select salesorderid, strftime(orderdate, '%Y-%m-%d') as order_day from sales_salesorderheader",
    "fn_case_decode": f"select salesorderid, status, {_status_case('status')} as order_status_name from sales_salesorderheader",
    "fn_cast_date": "select salesorderid, cast(orderdate as date) as orderdate from sales_salesorderheader",
    "fn_revenue": "select salesorderid, salesorderdetailid, cast(unitprice * orderqty as decimal(18,2)) as revenue from sales_salesorderdetail",
    "scd2_classify": "select key as customerid, action from customer_classified",
    "scd2_initial": _first_load("scd2_initial", "stg_dim_customer", "customerid", sc.FIRST_LOAD_DATE),
    "scd2_merge": f"select {', '.join(CUST_COLS + SCD_COLS)} from customer_merged",
    "scd2_insert": _merge_rows("INSERT"),
    "scd2_update": _merge_rows("UPDATE"),
    "scd2_delete": _merge_rows("DELETE"),
    "scd2_nochange": _merge_rows("NOCHANGE"),
    "stg_dim_address": "select * from stg_dim_address",
    "stg_dim_credit_card": "select * from stg_dim_credit_card",
    "stg_dim_customer": "select * from stg_dim_customer",
    "stg_dim_order_status": "select * from stg_dim_order_status",
    "stg_dim_product": "select * from stg_dim_product",
    "stg_date": "select * from stg_date",
    "landing_initial": "select * from landed_detail",
    "landing_incremental": f"""select * from (
          select salesorderid, salesorderdetailid, productid, orderqty, unitprice, modifieddate
          from landed_detail t where modifieddate <= timestamp '{sc.LANDING_CUTOFF}'
            and not exists (select 1 from inc i where i.salesorderid = t.salesorderid
                                                  and i.salesorderdetailid = t.salesorderdetailid)
          union all
          select salesorderid, salesorderdetailid, productid, orderqty, unitprice, modifieddate
          from (select *, row_number() over (partition by salesorderid, salesorderdetailid
                  order by modifieddate desc nulls last, productid desc nulls last, orderqty desc nulls last,
                           unitprice desc nulls last, _deleted desc nulls last) as _rn from inc) n
          where _rn = 1 and _deleted = false) u""",
    "landing_versions": """select salesorderid, salesorderdetailid, productid, orderqty, unitprice, modifieddate, _deleted
        from (select *, row_number() over (partition by salesorderid, salesorderdetailid
                order by modifieddate desc nulls last, productid desc nulls last, orderqty desc nulls last,
                         unitprice desc nulls last, _deleted desc nulls last) as _rn
              from sales_salesorderdetail) v where _rn = 1""",
    "publish_roundtrip": "select * from stg_dim_product",
    "sink_append": "select * from stg_dim_product",
    "sink_truncate_load": "select * from stg_dim_product",
    "sink_create_or_replace": "select * from stg_dim_address",
    "target_exists": f"""select 'full' as target, count(*) > 0 as has_rows from sales_salesorderdetail where _deleted = false
        union all select 'empty', count(*) > 0 from sales_salesorderdetail where salesorderid < 0
        union all select 'missing', false
        union all select 'changes', count(*) > 0 from sales_salesorderdetail where modifieddate > timestamp '{sc.LANDING_CUTOFF}'
        union all select 'no_changes', count(*) > 0 from sales_salesorderdetail
          where modifieddate > timestamp '{sc.LANDING_CUTOFF}' and orderqty < 0""",
    "upsert_partitions_months": f"""select salesorderid, case when strftime(orderdate, '%Y%m') = '{sc.UPSERT_MONTH}'
          then -customerid else customerid end as customerid, status, strftime(orderdate, '%Y%m') as month
        from sales_salesorderheader""",
    "dimension_two_runs": f"select {', '.join(CUST_COLS + SCD_COLS)} from customer_merged",
    "sales_fact": "select * from sales_fact",
    "sales_fact_incremental": f"""select {', '.join(FACT_COLS)} from upsert_target t
          where not exists (select 1 from fresh s where s.sales_key = t.sales_key)
        union all select {', '.join(FACT_COLS)} from (
          select *, row_number() over (partition by sales_key order by {_FACT_TIE}) as _rn from fresh) f where _rn = 1""",
    "revenue_by_dimension": """select p.product_category_name, a.country_name, cast(year(f.orderdate) as int) as order_year,
          cast(sum(f.revenue) as decimal(18,2)) as revenue, count(*) as line_count
        from sales_fact f left join dim_product p on f.product_key = p.sk_id
        left join dim_address a on f.ship_address_key = a.sk_id
        group by all""",
}

# Extra CTEs local to one query.
VIEWS["inc"] = f"""select * from sales_salesorderdetail where modifieddate >= (
    select max(modifieddate) from landed_detail where modifieddate <= timestamp '{sc.LANDING_CUTOFF}')"""
VIEWS["fresh"] = "select * from sales_fact where orderdate >= (select max(orderdate) from upsert_target)"

ORACLE_SQL: dict[str, str] = {name: with_views(sql) for name, sql in _RAW.items()}
