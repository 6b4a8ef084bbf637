"""The five SCD2 dimensions and the calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from starloom import conf
from starloom.functions.scalar import date_literal, surrogate_hash
from starloom.operators.scd2 import DimensionSpec, scd2_initial, scd2_merge
from starloom.operators.scd2_digest import BUCKET, bucket_of, merge_touched
from starloom.sources.publish import overwrite_partitions
from starloom.sources.statistics import greatest

# The natural keys and tracked columns of the dimensions, and the columns
# of the calendar.
DIMENSIONS = (
    DimensionSpec("dim_address", "stg_dim_address", "addressid",
                  ("city_name", "state_name", "country_name")),
    DimensionSpec("dim_creditcard", "stg_dim_credit_card", "creditcardid", ("cardtype",)),
    DimensionSpec("dim_customer", "stg_dim_customer", "customerid",
                  ("businessentityid", "fullname", "storebusinessentityid", "storename")),
    DimensionSpec("dim_orderstatus", "stg_dim_order_status", "order_status",
                  ("order_status_name",)),
    DimensionSpec("dim_product", "stg_dim_product", "productid",
                  ("product_name", "productnumber", "color", "product_subcategory_name",
                   "product_category_name")),
)
DIMENSION_BY_NAME = {d.name: d for d in DIMENSIONS}

DATE_COLUMNS = ("prior_year_over_year_date_day", "next_date_day", "day_of_year", "date_day",
                "day_of_month", "prior_date_day", "day_of_week", "day_of_week_name",
                "prior_year_date_day")


def build_dimension(spec: DimensionSpec, staging: DataFrame, history: DataFrame | None,
                    load_date, fingerprint: str = "safe") -> DataFrame:
    """Initial load when there is no history, otherwise an SCD2 merge."""
    if history is None:
        return scd2_initial(staging, spec.key, load_date)
    return scd2_merge(history, staging, spec.key, spec.tracked, load_date, fingerprint)


def dim_date(stg_date: DataFrame) -> DataFrame:
    """Calendar dimension: hash key of the day plus the staged columns
    (narrow: one projection, no shuffle)."""
    days = stg_date.select(*DATE_COLUMNS)
    return days.select(surrogate_hash(["date_day"]).alias("date_key"), "*")


# -- stored dimensions ------------------------------------------------------------------

# The bucket of every closed version: a closed one is never compared again.
CLOSED = -1
# The surrogate key (never given to a version) of the placeholder that keeps a partition
# which lost its rows.
NO_KEY = 0


def _stored(history: DataFrame, key: str, buckets: int) -> DataFrame:
    is_open = F.coalesce(F.col(conf.CURRENT_COL) == F.lit(True), F.lit(False))
    return history.withColumn(BUCKET, F.when(is_open, bucket_of(key, buckets)).otherwise(F.lit(CLOSED)))


def store_dimension(history: DataFrame, path: str, key: str, buckets: int) -> dict:
    """Store a whole history, partitioned by the day that versions end and the bucket
    of the open ones."""
    return overwrite_partitions(_stored(history, key, buckets), path, conf.EXPIRATION_COL, BUCKET)


def read_dimension(spark: SparkSession, path: str, staged: StructType, open_only: bool = False,
                   with_bucket: bool = False) -> DataFrame:
    """A stored dimension; ``staged`` is the schema of its staging table. Open versions
    alone are read from their own partitions, closed history is not listed."""
    columns = [*staged.fields, *StructType.fromDDL(
        f"{conf.SK_COL} long, {conf.EFFECTIVE_COL} date, {conf.EXPIRATION_COL} date, {conf.CURRENT_COL} boolean").fields]
    stored = spark.read.schema(StructType([*columns, StructField(BUCKET, IntegerType())])).parquet(path)
    if open_only:
        stored = stored.filter(F.col(BUCKET) >= 0)
    stored = stored.filter(F.col(conf.SK_COL) != NO_KEY)
    return stored.select(*[c.name for c in columns], *([BUCKET] if with_bucket else []))


def merge_stored_dimension(spark: SparkSession, path: str, spec: DimensionSpec, staging: DataFrame, load_date,
                           buckets: int) -> int:
    """Merge staged rows into a stored dimension, rewriting only the open versions of
    buckets that differ and the versions that ended on ``load_date`` (those that an
    earlier run of that day closed are kept). Returns the number of such buckets.
    Nothing is written when all digests agree, so a repeated run changes nothing."""
    opened = read_dimension(spark, path, staging.schema, open_only=True, with_bucket=True)
    max_sk = greatest(spark, path, conf.SK_COL) or 0
    merged, differ = merge_touched(opened, staging, spec.key, spec.tracked, load_date, buckets, max_sk)
    if not differ:
        return 0
    load = date_literal(load_date)
    ended = read_dimension(spark, path, staging.schema).filter(
        (F.col(conf.EXPIRATION_COL) == load) & ~F.col(conf.CURRENT_COL))
    rows = _stored(merged.drop("action").unionByName(ended), spec.key, buckets)
    # One row for each bucket written, for those whose last key is gone.
    kept = spark.createDataFrame([(b, NO_KEY) for b in differ], f"{BUCKET} int, {conf.SK_COL} long").withColumn(
        conf.EXPIRATION_COL, date_literal(conf.OPEN_END_DATE))
    overwrite_partitions(rows.unionByName(kept, allowMissingColumns=True), path, conf.EXPIRATION_COL, BUCKET)
    return len(differ)
