"""Staged dimension tables: live rows of the operational tables with their
lookups denormalized. Each builder is a lazy DataFrame function of a source
reader; lookups are left joins so a missing or deleted parent gives NULL
names, never a lost row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalar import decode_order_status, full_name
from starloom.operators.cdc import live_rows, not_null
from starloom.operators.columns import drop_metadata
from starloom.operators.delta import Lineage, Parent
from starloom.operators.lookup import distinct_keys, lookup
from starloom.sources.tables import SourceReader


def stg_dim_address(read: SourceReader) -> DataFrame:
    address = live_rows(read("person_address"))
    state = live_rows(read("person_stateprovince"))
    country = live_rows(read("person_countryregion"))
    df = lookup(address, state, "stateprovinceid",
                {"state_name": "name", "_countryregioncode": "countryregioncode"})
    df = lookup(df, country, ("_countryregioncode", "countryregioncode"), {"country_name": "name"})
    return df.select("addressid", F.col("city").alias("city_name"), "state_name", "country_name")


def stg_dim_credit_card(read: SourceReader) -> DataFrame:
    used = distinct_keys(live_rows(not_null(read("sales_salesorderheader"), "creditcardid")),
                         "creditcardid")
    cards = live_rows(read("sales_creditcard"))
    return lookup(used, cards, "creditcardid", ["cardtype"]).select("creditcardid", "cardtype")


def stg_dim_customer(read: SourceReader) -> DataFrame:
    customer = live_rows(read("sales_customer")).select("customerid", "personid", "storeid")
    person = live_rows(read("person_person")).select(
        "businessentityid", full_name("firstname", "middlename", "lastname").alias("fullname"))
    store = live_rows(read("sales_store")).select(
        F.col("businessentityid").alias("storebusinessentityid"), "name")
    df = lookup(customer, person, ("personid", "businessentityid"),
                ["businessentityid", "fullname"])
    df = lookup(df, store, ("storeid", "storebusinessentityid"),
                {"storebusinessentityid": "storebusinessentityid", "storename": "name"})
    return df.select("customerid", "businessentityid", "fullname", "storebusinessentityid",
                     "storename")


def stg_dim_order_status(read: SourceReader) -> DataFrame:
    codes = distinct_keys(live_rows(read("sales_salesorderheader"))
                          .select(F.col("status").alias("order_status")), "order_status")
    return codes.select("order_status",
                        decode_order_status("order_status").alias("order_status_name"))


def stg_dim_product(read: SourceReader) -> DataFrame:
    product = live_rows(read("production_product"))
    sub = live_rows(read("production_productsubcategory"))
    cat = live_rows(read("production_productcategory"))
    df = lookup(product, sub, "productsubcategoryid",
                {"product_subcategory_name": "name", "_productcategoryid": "productcategoryid"})
    df = lookup(df, cat, ("_productcategoryid", "productcategoryid"),
                {"product_category_name": "name"})
    return df.select("productid", F.col("name").alias("product_name"), "productnumber", "color",
                     "product_subcategory_name", "product_category_name")


def stg_date(read: SourceReader) -> DataFrame:
    return drop_metadata(live_rows(read("date_src")))


STAGING_BUILDERS = {
    "stg_dim_address": stg_dim_address,
    "stg_dim_credit_card": stg_dim_credit_card,
    "stg_dim_customer": stg_dim_customer,
    "stg_dim_order_status": stg_dim_order_status,
    "stg_dim_product": stg_dim_product,
    "stg_date": stg_date,
}

# Where the rows of the joined staged tables come from, for staging by changes.
LINEAGE = {
    "stg_dim_address": Lineage("person_address", "addressid", (
        Parent("person_stateprovince", "stateprovinceid", "person_address", "stateprovinceid"),
        Parent("person_countryregion", "countryregioncode", "person_stateprovince", "countryregioncode"))),
    "stg_dim_customer": Lineage("sales_customer", "customerid", (
        Parent("person_person", "businessentityid", "sales_customer", "personid"),
        Parent("sales_store", "businessentityid", "sales_customer", "storeid"))),
    "stg_dim_product": Lineage("production_product", "productid", (
        Parent("production_productsubcategory", "productsubcategoryid", "production_product", "productsubcategoryid"),
        Parent("production_productcategory", "productcategoryid", "production_productsubcategory",
               "productcategoryid"))),
}
