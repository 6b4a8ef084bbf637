"""Sinks: Spark's own writers, with row counts and other aggregates observed while
they write (no extra job).

Tables that are rebuilt from their sources are overwritten. Tables that a run reads and
changes are partitioned, and a run replaces whole partitions by a dynamic partition
overwrite: old files go when the job commits, after every task has read them, so reading
and rewriting the same partitions is safe. Such an overwrite leaves a partition that
gets no rows as it was; where an upsert may empty partitions each one written carries
one placeholder row, which :func:`read_upserted` leaves out.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import threading
import uuid
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from starloom.operators.cdc import newest_per_key
from starloom.session import materialize
from starloom.sources.tables import path_has_data

# Formats whose tables are directories of files.
FILE_FORMATS = ("parquet", "orc", "avro", "json", "csv", "text")
PLACEHOLDER = "_placeholder"
_SETTING = threading.Lock()


def new_run_id() -> str:
    """Sortable, unique run id: UTC time plus a random suffix."""
    now = _dt.datetime.now(_dt.timezone.utc)
    return f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _observed(df: DataFrame, aggregates: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    seen = Observation(f"write-{uuid.uuid4().hex[:12]}")
    return df.observe(seen, *[c.alias(n) for n, c in aggregates.items()]), seen


def _rows() -> Column:
    return F.count(F.lit(1))


def overwrite(df: DataFrame, path: str, **aggregates: Column) -> dict:
    """Replace the dataset at ``path`` by ``df``, which must not read it. Returns the
    row count (``rows``) and the aggregates, observed during the write."""
    df, seen = _observed(df, {"rows": _rows(), **aggregates})
    df.write.mode("overwrite").parquet(path)
    return dict(seen.get)


def overwrite_partitions(df: DataFrame, path: str, *part_cols: str, derived: Mapping[str, Column] | None = None,
                         placed: bool = False, **aggregates: Column) -> dict:
    """Replace the partitions that ``df`` has rows of; ``df`` may read them. Rows are
    rebalanced first: a partition gets files by its size, not one from every task, and
    a hot one is split (``placed`` says that they are in ranges of the partition
    columns already). ``derived`` columns are added behind that shuffle. Returns as
    :func:`overwrite`."""
    if not placed:
        df = df.hint("rebalance", *part_cols)
    df, seen = _observed(df.withColumns(dict(derived or {})), {"rows": _rows(), **aggregates})
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
       .partitionBy(*part_cols).parquet(path))
    return dict(seen.get)


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def append(df: DataFrame, target: str, fmt: str = "parquet", options: dict[str, str] | None = None) -> None:
    """Append to a catalog table, a path, or (formats outside FILE_FORMATS)
    the connector's table of that name."""
    writer = df.write.mode("append").format(fmt).options(**(options or {}))
    if fmt not in FILE_FORMATS:
        writer.option("dbtable", target).save()
    elif _is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)


def create_or_replace(df: DataFrame, target: str, fmt: str = "parquet", options: dict[str, str] | None = None) -> None:
    """Create a catalog table, or replace its contents and its schema. A table of
    another catalog than the session's (``catalog.database.table``) is replaced by
    that catalog in one step; the session catalog replaces by overwriting."""
    if target.count(".") == 2 and not target.startswith("spark_catalog."):
        writer = df.writeTo(target).using(fmt)
        for name, value in (options or {}).items():
            writer = writer.tableProperty(name, value)
        writer.createOrReplace()
    else:
        df.write.mode("overwrite").format(fmt).options(**(options or {})).saveAsTable(target)


@contextlib.contextmanager
def _whole_tables(spark: SparkSession) -> Iterator[None]:
    """An overwriting insert replaces all partitions of its table (an insert takes
    this from the session only; other writes here say what they want themselves)."""
    name = "spark.sql.sources.partitionOverwriteMode"
    with _SETTING:
        old = spark.conf.get(name)
        spark.conf.set(name, "static")
        try:
            yield
        finally:
            spark.conf.set(name, old)


def truncate_load(df: DataFrame, target: str, fmt: str = "parquet", options: dict[str, str] | None = None) -> None:
    """Replace the contents of a target that no reader of ``df`` depends on
    (a warehouse copy). Connectors get ``dbtable`` and ``truncate``, so they
    keep the table's definition; an existing catalog table keeps its columns
    and partitioning and is replaced by one insert."""
    writer = df.write.mode("overwrite").format(fmt).options(**(options or {}))
    if fmt not in FILE_FORMATS:
        writer.option("truncate", "true").option("dbtable", target).save()
    elif _is_path(target):
        writer.save(target)
    elif df.sparkSession.catalog.tableExists(target):
        columns = df.sparkSession.table(target).columns
        with _whole_tables(df.sparkSession):
            df.select(*columns).write.insertInto(target, overwrite=True)
    else:
        writer.saveAsTable(target)


def _stored_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(PLACEHOLDER, BooleanType())])


def read_upserted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a table kept by :func:`upsert_partitions`. The schema is the rows'
    own: inferring it would read a partition '01' as a number."""
    stored = spark.read.schema(_stored_schema(schema)).parquet(path)
    return stored.filter(~F.col(PLACEHOLDER)).drop(PLACEHOLDER)


def _in(column: str, values: list) -> Column:
    found = F.col(column).isin([v for v in values if v is not None])
    return found | F.col(column).isNull() if None in values else found


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, key: str | Sequence[str],
                      part_col: str, order_cols: Sequence[str] | None = None,
                      remove_keys: DataFrame | None = None, metrics: dict | None = None,
                      partition_follows_key: bool = False, derived: Mapping[str, Column] | None = None,
                      parts: DataFrame | None = None, removes_all: bool = False) -> list:
    """Keyed upsert into a partitioned dataset that rewrites only the partitions it
    touches: those that the new rows belong to, and those that hold an older version
    of one of their keys (a semi join over the key and partition columns). Their new
    content is the old rows of other keys and the new rows.

    Old and new rows are put in ranges of partition and key by one shuffle, in which
    old rows of new keys are left out and which the files are written from.

    ``remove_keys`` (key columns only) removes the rows of those keys even where
    ``source`` brings no replacement; ``source`` may then hold several rows per key
    (all lines of an order). ``removes_all`` states that they hold every key of
    ``source``. ``metrics`` maps names to aggregates over the rows
    written and receives their values. ``partition_follows_key`` states that the
    partition is a function of the key, so no older version lives elsewhere and the
    search for it is left out. ``derived`` are columns of ``source`` that follow from
    its others: they are made again where rows are written, not shuffled. ``parts``
    are the partitions of the rows of ``source``, where the caller finds them by less work.

    Returns the partitions written (one value for each: bounded by the table's)."""
    keys = [key] if isinstance(key, str) else list(key)
    place = [part_col, *(k for k in keys if k != part_col)]
    first = not path_has_data(spark, path)
    if order_cols and first and partition_follows_key:
        # Equal keys have equal places: one shuffle for the newest and for the files.
        source = source.repartitionByRange(*place)
    src = newest_per_key(source, place if partition_follows_key else keys, order_cols) if order_cols else source
    schema = src.schema
    src = src.drop(*(derived or {}))

    def write(df: DataFrame, placed: bool) -> None:
        # Aggregates see the rows, not the placeholders (their columns are null).
        got = overwrite_partitions(df, path, part_col, derived=derived, placed=placed, **(metrics or {}))
        if metrics:
            metrics.update({n: got[n] for n in metrics})

    if first:
        write(src.withColumn(PLACEHOLDER, F.lit(False)), placed=bool(order_cols) and partition_follows_key)
        stored = spark.read.schema(_stored_schema(schema)).parquet(path)
        return sorted((r[0] for r in stored.select(part_col).distinct().collect()), key=str)
    target = read_upserted(spark, path, schema).select(*src.columns)
    parts = src.select(part_col) if parts is None else parts.select(part_col)
    gone = None
    if not partition_follows_key or remove_keys is not None:
        gone = None if removes_all else src.select(*keys)
        if remove_keys is not None:
            given = remove_keys.select(*keys)
            gone = given if gone is None else gone.unionByName(given)
        # Where old rows of those keys live: rows of one key meet before they are shuffled.
        homes = (target.groupBy(*keys).agg(F.collect_set(F.struct(F.col(part_col).alias("_home"))).alias("_homes"))
                 .join(gone.distinct(), keys, "left_semi").select(*keys, F.explode("_homes").alias("_at"))
                 .select(*[k for k in keys if k != part_col], F.col("_at._home").alias(part_col)))
        gone = materialize(homes)
        if not partition_follows_key:
            parts = parts.union(gone.select(part_col))
    affected = [r[0] for r in parts.distinct().collect()]
    if not affected:
        return []
    old = target.filter(_in(part_col, affected)).withColumn("_new", F.lit(0))
    rows = old.unionByName(src.withColumn("_new", F.lit(1)))
    if gone is not None:
        rows = rows.unionByName(gone.withColumn("_new", F.lit(2)), allowMissingColumns=True)
    if not partition_follows_key:
        kept = StructType([src.schema[part_col]])
        placeholders = spark.createDataFrame([(v,) for v in affected], kept).withColumn("_new", F.lit(3))
        rows = rows.unionByName(placeholders, allowMissingColumns=True)
    newest = F.max("_new").over(Window.partitionBy(*place))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    # A row without a key is never an older version of another.
    rows = (rows.repartitionByRange(*place).withColumn("_newest", newest)
            .filter(F.col("_new").isin(1, 3) | (F.col("_new") == 0) & ((F.col("_newest") == 0) | no_key))
            .withColumn(PLACEHOLDER, F.col("_new") == 3).drop("_new", "_newest"))
    write(rows, placed=True)
    return affected
