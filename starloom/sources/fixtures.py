"""Source tables of the operational schema, derived from the shared test
tables (TPC-H-like parquet) with soft-delete flags, NULLs and dangling
parents. Every view is a lazy DataFrame over the parquet scan, so its work
grows with the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The shared test tables are read-only: infer each file's schema once.
_SCHEMAS: dict[str, StructType] = {}


def _flag(key: Column) -> Column:
    """Deleted when key % 13 = 0, unknown (NULL) when key % 17 = 0."""
    return (F.when(key % 13 == 0, F.lit(True))
             .when(key % 17 == 0, F.lit(None).cast("boolean"))
             .otherwise(F.lit(False)))


class FixtureSource:
    """``source(name) -> DataFrame`` over ``{sf_dir}/{table}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        schema = _SCHEMAS.get(path)
        if schema is None:
            df = self.spark.read.parquet(path)
            _SCHEMAS[path] = df.schema
            return df
        return self.spark.read.schema(schema).parquet(path)

    def __call__(self, name: str) -> DataFrame:
        builder = getattr(self, f"_{name}", None)
        if builder is None:
            raise KeyError(f"unknown source {name!r}")
        return builder()

    # -- person ------------------------------------------------------------
    def _person_address(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            k.alias("addressid"),
            F.concat(F.lit("City_"), F.col("c_mktsegment")).alias("city"),
            F.when(k % 10 == 9, F.lit(None)).otherwise(F.col("c_nationkey")).cast("int")
             .alias("stateprovinceid"),
            _flag(k).alias("_deleted"))

    def _person_stateprovince(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self.table("nation").select(
            k.alias("stateprovinceid"), F.col("n_name").alias("name"),
            F.when(k == 7, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")))
             .alias("countryregioncode"),
            (k % 6 == 5).alias("_deleted"))

    def _person_countryregion(self) -> DataFrame:
        k = F.col("r_regionkey")
        return self.table("region").select(
            F.concat(F.lit("R"), k.cast("string")).alias("countryregioncode"),
            F.col("r_name").alias("name"), (k == 4).alias("_deleted"))

    def _person_person(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            (k + 100000).alias("businessentityid"),
            F.when(k % 50 == 1, F.lit(None)).otherwise(F.col("c_name")).alias("firstname"),
            F.when(k % 2 == 0, F.lit("M")).alias("middlename"),
            F.when(k % 50 == 1, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("lastname"),
            (k % 29 == 0).alias("_deleted"))

    # -- production --------------------------------------------------------
    def _production_product(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.table("part").select(
            k.alias("productid"), F.col("p_name").alias("name"),
            F.concat(F.lit("PN-"), k.cast("string")).alias("productnumber"),
            F.when(k % 8 == 3, F.lit(None))
             .otherwise(F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))).alias("color"),
            F.when(k % 9 == 0, F.lit(None)).otherwise(F.col("p_size")).cast("int")
             .alias("productsubcategoryid"),
            _flag(k).alias("_deleted"))

    def _production_productsubcategory(self) -> DataFrame:
        s = F.col("p_size")
        return self.table("part").select(
            s.alias("productsubcategoryid"),
            F.concat(F.lit("Sub_"), s.cast("string")).alias("name"),
            (s % 7).alias("productcategoryid"), (s % 10 == 3).alias("_deleted")).distinct()

    def _production_productcategory(self) -> DataFrame:
        c = F.col("p_size") % 7
        return (self.table("part").filter(c < 6).select(
            c.alias("productcategoryid"),
            F.concat(F.lit("Cat_"), c.cast("string")).alias("name"),
            (c == 2).alias("_deleted")).distinct())

    # -- sales -------------------------------------------------------------
    def _sales_customer(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            k.alias("customerid"),
            F.when(k % 4 != 0, k + 100000).alias("personid"),
            F.when(k % 3 == 0, F.expr("c_custkey div 15")).alias("storeid"),
            _flag(k).alias("_deleted"))

    def _sales_store(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.table("supplier").select(
            k.alias("businessentityid"), F.col("s_name").alias("name"),
            (k % 7 == 6).alias("_deleted"))

    def _sales_salesorderheader(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.table("orders").select(
            k.alias("salesorderid"), F.col("o_custkey").alias("customerid"),
            F.when(k % 5 != 0, F.col("o_custkey")).alias("creditcardid"),
            F.col("o_custkey").alias("shiptoaddressid"),
            F.when(k % 40 == 39, F.lit(None)).otherwise((k % 8).cast("int")).cast("int")
             .alias("status"),
            F.col("o_orderdate").alias("orderdate"), F.col("o_orderdate").alias("modifieddate"),
            _flag(k).alias("_deleted"))

    def _sales_salesorderdetail(self) -> DataFrame:
        k = F.col("l_orderkey")
        return self.table("lineitem").select(
            k.alias("salesorderid"),
            (F.col("l_partkey") * 100000 + F.col("l_suppkey") * 10 + F.col("l_linenumber"))
             .alias("salesorderdetailid"),
            F.col("l_partkey").alias("productid"),
            F.col("l_quantity").cast("int").alias("orderqty"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("unitprice"),
            F.col("l_shipdate").alias("modifieddate"),
            _flag(k).alias("_deleted"))

    def _sales_creditcard(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.table("part").select(
            k.alias("creditcardid"), F.col("p_type").alias("cardtype"),
            (k % 23 == 0).alias("_deleted"))

    # -- calendar ----------------------------------------------------------
    def _date_src(self) -> DataFrame:
        d = F.col("d")
        offset = F.datediff(d, F.lit("1995-01-01").cast("date")) % 7
        names = F.when(offset == 0, "Sunday").when(offset == 1, "Monday") \
                 .when(offset == 2, "Tuesday").when(offset == 3, "Wednesday") \
                 .when(offset == 4, "Thursday").when(offset == 5, "Friday").otherwise("Saturday")
        days = self.table("orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
        return days.select(
            d.alias("date_day"), F.date_sub(d, 1).alias("prior_date_day"),
            F.date_add(d, 1).alias("next_date_day"),
            F.add_months(d, -12).alias("prior_year_date_day"),
            F.date_sub(d, 364).alias("prior_year_over_year_date_day"),
            F.dayofyear(d).cast("int").alias("day_of_year"),
            F.dayofmonth(d).cast("int").alias("day_of_month"),
            (offset + 1).cast("int").alias("day_of_week"), names.alias("day_of_week_name"),
            (F.dayofmonth(d) == 31).alias("_deleted"))

    _date = _date_src


SOURCE_NAMES = (
    "person_address", "person_stateprovince", "person_countryregion", "production_product",
    "production_productsubcategory", "production_productcategory", "sales_customer",
    "person_person", "sales_store", "sales_salesorderheader", "sales_salesorderdetail",
    "sales_creditcard", "date_src",
)
