"""Connected components of a link table, by alternating large-star and
small-star steps (each a grouped minimum and a join), so a hub's neighbours
are never gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove_path, shared_path


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema("a long, b long").parquet(path)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every id has links to one lesser id only, and that one to none."""
    ends = links.select(F.col("a").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return (ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .filter("up > 1 or up + down > 1 and up > 0 and down > 0").isEmpty())


def components(links: DataFrame) -> DataFrame:
    """`links` has columns a, b (long). Returns (id, component_id) for every id
    that has a link to another: the smallest id that links lead to. Links from
    an id to itself and links with a null say nothing; repeated links count
    once; no links give no rows."""
    spark = links.sparkSession
    links = links.filter("a <> b").select(F.greatest("a", "b").cast("long").alias("a"),
                                          F.least("a", "b").cast("long").alias("b")).distinct()
    path = shared_path(spark, "links")
    links = _write(links, path)
    while not _stars(links):
        older, path = path, shared_path(spark, "links")
        links = _write(_small_star(_large_star(links)), path)
        remove_path(spark, older)
    # Only stars are left: every link goes to the least id of its component.
    return (links.groupBy("a").agg(F.min("b").alias("component_id")).withColumnRenamed("a", "id")
            .unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()))
