"""DuckDB SQL of the incremental queries: each states the full rebuild over the present
state of the sources that keeping a table by changes must equal."""

from __future__ import annotations

import re

from starloom import incremental as inc
from starloom.oracle import (CUST_COLS, ORACLE_SQL, SCD_COLS, TRACKED, VIEWS, _FACT_SELECT, _RAW, fp_safe,
                             with_views)
from starloom.plans import scenarios as sc
from starloom.plans.dimensions import DIMENSIONS
from starloom.sources.fixture_changes import CHANGED_AT

OPEN = "9999-12-31"

# The present state of the changed sources: {column: expression} over the fixture's
# view, new rows included.
_CHANGES = {
    "person_address": {
        "stateprovinceid": "case when addressid % 47 = 7 then cast((coalesce(stateprovinceid, 0) + 1) % 25 as int) else stateprovinceid end",
        "city": "case when addressid % 53 = 9 then city || '_v2' else city end",
        "_deleted": "case when addressid % 43 = 5 then true else _deleted end"},
    "person_stateprovince": {
        "name": "case when stateprovinceid = 3 then name || '_new' else name end",
        "countryregioncode": "case when stateprovinceid = 8 then 'R1' else countryregioncode end",
        "_deleted": "case when stateprovinceid = 11 then false when stateprovinceid = 14 then true else _deleted end"},
    "person_countryregion": {"name": "case when countryregioncode = 'R2' then name || '_new' else name end"},
    "sales_customer": {
        "personid": "case when customerid % 47 = 7 then personid + 1 else personid end",
        "_deleted": "case when customerid % 43 = 5 then true else _deleted end"},
    "person_person": {
        "lastname": "case when businessentityid % 59 = 4 then lastname || '_m' else lastname end",
        "_deleted": "case when businessentityid % 61 = 8 then true else _deleted end"},
    "sales_store": {
        "name": "case when businessentityid % 5 = 2 then name || '_new' else name end",
        "_deleted": "case when businessentityid % 11 = 6 then false else _deleted end"},
    "production_product": {
        "color": "case when productid % 47 = 7 then null else color end",
        "_deleted": "case when productid % 43 = 5 then true else _deleted end"},
    "production_productsubcategory": {
        "name": "case when productsubcategoryid = 4 then name || '_new' else name end",
        "productcategoryid": "case when productsubcategoryid = 10 then (productcategoryid + 1) % 7 else productcategoryid end"},
    "production_productcategory": {"name": "case when productcategoryid = 1 then name || '_new' else name end"},
    "sales_salesorderdetail": {
        "orderqty": "case when salesorderid % 59 = 11 then 99 else orderqty end",
        "modifieddate": f"case when salesorderid % 41 = 3 or salesorderid % 59 = 11 or salesorderid % 61 = 5 then timestamp '{CHANGED_AT}' else modifieddate end",
        "_deleted": "case when salesorderid % 61 = 5 then true else _deleted end"},
    "sales_salesorderheader": {
        "modifieddate": f"case when salesorderid % 41 = 3 or salesorderid % 3 = 1 or salesorderid % 47 = 7 or salesorderid % 53 = 9 then timestamp '{CHANGED_AT}' else modifieddate end",
        "creditcardid": "case when salesorderid % 47 = 7 then customerid + 1 else creditcardid end",
        "status": "case when salesorderid % 53 = 9 then 2 else status end",
        "_deleted": "case when salesorderid % 3 = 1 then true else _deleted end"},
}
_NEW = {"person_address": "addressid % 41 = 3", "sales_customer": "customerid % 41 = 3",
        "person_person": "businessentityid % 67 = 3", "production_product": "productid % 41 = 3",
        "sales_salesorderheader": "salesorderid % 41 = 3", "sales_salesorderdetail": "salesorderid % 41 = 3"}


def _in_state(sql: str, suffix: str) -> str:
    """A staged table's SQL over the sources of one state."""
    return re.sub(r"\b(" + "|".join(_CHANGES) + r")\b", rf"\1_{suffix}", sql)


for _name, _columns in _CHANGES.items():
    VIEWS[f"{_name}_now"] = f"select * replace ({', '.join(f'{e} as {c}' for c, e in _columns.items())}) from {_name}"
    VIEWS[f"{_name}_then"] = f"select * from {_name} where not {_NEW.get(_name, 'false')}"
for _name in ("stg_dim_address", "stg_dim_customer", "stg_dim_product", "stg_dim_credit_card", "stg_dim_order_status"):
    for _state in ("then", "now"):
        VIEWS[f"{_name}_{_state}"] = _in_state(VIEWS[_name], _state)


def merge_sql(history: str, current: str, key: str, cols: list[str], tracked: list[str], load: str,
              fill: list[str] = ()) -> str:
    """SCD2 merge of `current` into `history`; unchanged rows take `fill` columns."""
    h = ", ".join(f"h.{c} as h_{c}" for c in cols + SCD_COLS)
    c = ", ".join(f"c.{c} as c_{c}" for c in cols)
    kept = ", ".join(f"case when action = 'NOCHANGE' then c_{x} else h_{x} end as {x}" if x in fill else f"h_{x} as {x}"
                     for x in cols)
    return f"""select {', '.join(cols + SCD_COLS)} from {history} where not coalesce(current_flag, false)
      union all select {kept}, h_sk_id as sk_id, h_effective_date as effective_date,
        case when action = 'NOCHANGE' then h_expiration_date else date '{load}' end as expiration_date,
        action = 'NOCHANGE' as current_flag from cls where action <> 'INSERT'
      union all select {', '.join(f'c_{x} as {x}' for x in cols)},
        cast((select coalesce(max(sk_id), 0) from {history}) + row_number() over (
          order by case when action = 'INSERT' then 0 else 1 end, c_{key} nulls first) as bigint) as sk_id,
        date '{load}' as effective_date, date '{OPEN}' as expiration_date, true as current_flag
      from cls where action in ('INSERT', 'UPDATE')
      """, f"""select {h}, {c}, case when in_h and in_c and h.fp = c.fp then 'NOCHANGE' when in_c is null then 'DELETE'
        when in_h is null then 'INSERT' else 'UPDATE' end as action
      from (select *, true as in_h, {fp_safe(tracked)} as fp from {history} where current_flag) h
      full outer join (select *, true as in_c, {fp_safe(tracked)} as fp from {current}) c
        on h.{key} is not distinct from c.{key}"""


def _merged(*args, **kwargs) -> str:
    body, cls = merge_sql(*args, **kwargs)
    return f"select * from (with cls as ({cls}) {body}) m"


VIEWS["address_history"] = (
    f"select *, cast(row_number() over (order by addressid nulls first) as bigint) as sk_id, "
    f"date '{sc.FIRST_LOAD_DATE}' as effective_date, date '{OPEN}' as expiration_date, true as current_flag "
    "from stg_dim_address_then")
VIEWS["older_history"] = "select * replace (cast(null as varchar) as storename) from customer_history"
VIEWS["backdated"] = f"""select * replace (
    case when customerid % 2 = 0 and effective_date = date '{sc.ASOF_MERGE_LOAD}' then date '{inc.BACKDATED}' else effective_date end as effective_date,
    case when customerid % 2 = 0 and expiration_date = date '{sc.ASOF_MERGE_LOAD}' then date '{inc.BACKDATED}' else expiration_date end as expiration_date)
    from customer_merged_asof"""

# The log of several events a key: the last of a day, after the open version.
VIEWS["log_days"] = f"""select * from (
    select customerid, businessentityid, coalesce(fullname, '') || '_e' || cast(seq // 2 as varchar) as fullname,
      storebusinessentityid, storename, date '{inc.LOG_START}' + cast((customerid * 3 + seq * 5) % {inc.LOG_DAYS} as int) as day,
      coalesce(case when (customerid + seq) % 17 = 0 then null else (customerid + seq) % 5 <> 0 end, false) as live,
      row_number() over (partition by customerid, (customerid * 3 + seq * 5) % {inc.LOG_DAYS} order by seq desc) as back
    from stg_dim_customer, range(1, {inc.LOG_EVENTS + 1}) r(seq) where customerid % 3 <> 1) e where back = 1"""
_STATE = ", ".join(CUST_COLS)
VIEWS["log_changes"] = f"""select * from (
    select *, coalesce(lag(live) over by_day, false) as was, lag(fp) over by_day as fp_was from (
      select {_STATE}, effective_date as day, true as live, 0 as event, sk_id, effective_date, {fp_safe(TRACKED)} as fp
      from customer_history where current_flag and customerid in (select customerid from log_days)
      union all select {_STATE}, day, live, 1, null, null, {fp_safe(TRACKED)} from log_days) s
    window by_day as (partition by customerid order by event, day)) t
    where event = 0 or live <> was or (live and fp <> fp_was)"""
VIEWS["log_ended"] = "select *, lead(day) over (partition by customerid order by event, day) as until from log_changes"

# Two daily runs: dimensions of a first load and after a merge, landed versions, facts.
for _dim in DIMENSIONS:
    _cols = [_dim.key, *_dim.tracked]
    VIEWS[f"{_dim.name}_then"] = (
        f"select {', '.join(_cols)}, cast(row_number() over (order by {_dim.key} nulls first) as bigint) as sk_id, "
        f"date '{sc.FIRST_LOAD_DATE}' as effective_date, date '{OPEN}' as expiration_date, true as current_flag "
        f"from {_dim.staging}_then")
    VIEWS[f"{_dim.name}_now"] = _merged(f"{_dim.name}_then", f"{_dim.staging}_now", _dim.key, _cols, list(_dim.tracked),
                                        sc.MERGE_LOAD_DATE)
for _state in ("then", "now"):
    VIEWS[f"landed_detail_{_state}"] = (
        f"select * from ({_in_state(_RAW['landing_versions'], _state)}) v where _deleted = false")
    VIEWS[f"landed_header_{_state}"] = _in_state(VIEWS["landed_header"], _state)
    VIEWS[f"sales_fact_{_state}"] = re.sub(
        r"\b(landed_detail|landed_header|" + "|".join(d.name for d in DIMENSIONS) + r")\b", rf"\1_{_state}", _FACT_SELECT)
VIEWS["touched_orders"] = """select salesorderid from sales_salesorderheader_now
      where modifieddate >= (select max(modifieddate) from sales_salesorderheader_then)
    union select salesorderid from sales_salesorderdetail_now
      where modifieddate >= (select max(modifieddate) from sales_salesorderdetail_then)
    union select salesorderid from landed_header_now
      where orderdate >= (select cast(max(orderdate) as timestamp) from sales_fact_then)"""

_SQL = {
    "daily_run_fact": """select * from sales_fact_then where salesorderid not in (select salesorderid from touched_orders)
        union all select * from sales_fact_now where salesorderid in (select salesorderid from touched_orders)""",
    "stg_delta_address": "select * from stg_dim_address_now",
    "stg_delta_customer": "select * from stg_dim_customer_now",
    "stg_delta_product": "select * from stg_dim_product_now",
    "scd2_merge_delta": _merged("address_history", "stg_dim_address_now", "addressid",
                                ["addressid", "city_name", "state_name", "country_name"],
                                ["city_name", "state_name", "country_name"], sc.MERGE_LOAD_DATE),
    "support_counts": "select status, count(*) as support from sales_salesorderheader_now where _deleted = false group by status",
    "stg_delta_order_status": "select * from stg_dim_order_status_now",
    "stg_delta_credit_card": "select * from stg_dim_credit_card_now",
    "scd2_merge_digest": f"select {', '.join(CUST_COLS + SCD_COLS)} from customer_merged",
    "scd2_change_log": f"""select {_STATE}, sk_id, effective_date, expiration_date, current_flag from customer_history
          where not (current_flag and customerid in (select customerid from log_days))
        union all select {_STATE}, sk_id, effective_date, coalesce(until, date '{OPEN}'), until is null
          from log_ended where event = 0
        union all select {_STATE}, cast((select coalesce(max(sk_id), 0) from customer_history)
            + row_number() over (order by day, was, customerid) as bigint), day, coalesce(until, date '{OPEN}'), until is null
          from log_ended where event = 1 and live""",
    "scd2_merge_evolved": _merged("older_history", "customer_batch2", "customerid", CUST_COLS, TRACKED, sc.MERGE_LOAD_DATE),
    "scd2_merge_evolved_fill": _merged("older_history", "customer_batch2", "customerid", CUST_COLS,
                                       [c for c in TRACKED if c != "storename"], sc.MERGE_LOAD_DATE, fill=["storename"]),
    "max_key_from_files": "select max(o_orderkey) as max_o_orderkey, max(o_custkey) as max_o_custkey from orders",
    "join_inner_bucketed": _RAW["join_inner"],
    "sales_fact_bucketed": "select * from sales_fact",
    "dim_lookup_as_of_sorted": _RAW["dim_lookup_as_of"],
    "upsert_home_rows": f"select * from sales_salesorderheader where modifieddate > timestamp '{sc.LANDING_CUTOFF}'",
    "sales_fact_repaired": _FACT_SELECT.replace(
        "left join (select * from dim_customer where current_flag = true) c on h.customerid = c.customerid",
        """left join backdated c on h.customerid = c.customerid
      and h.orderdate >= c.effective_date and h.orderdate < c.expiration_date"""),
}
ORACLE_SQL.update({name: with_views(sql) for name, sql in _SQL.items()})
