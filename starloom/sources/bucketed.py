"""Order tables stored in buckets of the order id, so that lines meet headers
without a shuffle.

Both landed tables are written with the same number of buckets by ``salesorderid``
(one file for each bucket: rows are repartitioned by the bucket's own hash first).
Spark then joins bucket with bucket: neither side passes an Exchange, on this run or
any later one.

A bucket join cannot be split at run time as a shuffle join can, so an order that
holds more lines than ``starloom.landing.hotOrderRows`` would keep one task busy. Such
orders are found while landing (a count by order id, at most rows / bound of them) and
their lines are stored apart, as ordinary files that many tasks read; they meet their
few headers by broadcast. Lines without an order id are stored there too.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import conf
from starloom.operators.lookup import checked_side
from starloom.session import materialize


@dataclass
class BucketedOrders:
    """Lines and headers in buckets of the order id; ``hot_lines`` are the lines of
    ``hot`` orders (and those without an id)."""
    lines: DataFrame
    headers: DataFrame
    hot_lines: DataFrame
    hot: DataFrame
    n_hot: int


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, table: str | None = None) -> DataFrame:
    """Store ``df`` at ``path`` in buckets of ``key``, sorted by it, and return it as
    stored. ``table`` names it in the session's catalog for later sessions; without
    one the catalog forgets it again (the files stay)."""
    spark = df.sparkSession
    name = table or f"bucketed_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.format("parquet").option("path", path)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    stored = spark.table(name)
    if table is None:
        stored.schema  # resolved before the name goes
        spark.sql(f"DROP TABLE {name}")
    return stored


def land_bucketed(spark: SparkSession, lines: DataFrame, headers: DataFrame, root: str, buckets: int | None = None,
                  key: str = "salesorderid", hot_rows: int | None = None) -> BucketedOrders:
    """Store landed lines and headers under ``root``, in buckets of the order id."""
    buckets = buckets or int(conf.tunable(spark, conf.ORDER_BUCKETS))
    hot_rows = hot_rows or int(conf.tunable(spark, conf.HOT_ORDER_ROWS))
    root = root.rstrip("/")
    hot = materialize(lines.groupBy(key).count().filter((F.col("count") > hot_rows) & F.col(key).isNotNull())
                      .select(F.col(key).alias("_hot")))
    n_hot = hot.count()
    marked = checked_side(hot.withColumn("_is_hot", F.lit(True)), True, n_hot)
    marked = lines.join(marked, lines[key] == marked["_hot"], "left").drop("_hot")
    apart = F.coalesce(F.col("_is_hot"), F.col(key).isNull())
    cold = write_bucketed(marked.filter(~apart).drop("_is_hot"), f"{root}/lines", key, buckets)
    marked.filter(apart).drop("_is_hot").write.parquet(f"{root}/hot_lines")
    return BucketedOrders(cold, write_bucketed(headers, f"{root}/headers", key, buckets),
                          spark.read.schema(lines.schema).parquet(f"{root}/hot_lines"), hot, n_hot)


def hot_headers(orders: BucketedOrders, key: str = "salesorderid") -> DataFrame:
    """Headers of the hot orders (no more rows than there are hot orders)."""
    side = checked_side(orders.hot, True, orders.n_hot)
    return checked_side(orders.headers.join(side, orders.headers[key] == side["_hot"], "left_semi"), True, orders.n_hot)


def join_lines(orders: BucketedOrders, key: str = "salesorderid") -> DataFrame:
    """Lines x headers (inner): bucket by bucket, hot orders by broadcast."""
    joined = orders.lines.join(orders.headers.hint("merge"), key)
    if not orders.n_hot:
        return joined
    return joined.unionByName(orders.hot_lines.join(hot_headers(orders, key), key).select(*joined.columns))
