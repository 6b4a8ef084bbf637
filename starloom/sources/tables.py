"""Scans: catalog tables and file datasets by format name (parquet default).

Filters and projections applied to the returned DataFrame reach the scan
(``PushedFilters`` / ``ReadSchema``); nothing here reads eagerly."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from starloom import conf

SourceReader = Callable[[str], DataFrame]


def scan(spark: SparkSession, target: str, fmt: str = "parquet",
         options: dict[str, str] | None = None) -> DataFrame:
    """Read a catalog table (``db.tbl`` or ``cat.db.tbl``) or a path.

    A target containing ``/`` or ``:`` is a path read with ``fmt``; otherwise
    it is a table name resolved by the session catalog (any format the
    catalog knows, e.g. a table-format catalog when one is configured)."""
    if "/" in target or ":" in target:
        return spark.read.format(fmt).options(**(options or {})).load(target)
    return spark.read.options(**(options or {})).table(target)


def table_reader(spark: SparkSession, database: str | None = None, fmt: str = "parquet",
                 root: str | None = None, flag: str = conf.DELETED_FLAG,
                 metadata: Sequence[str] = ()) -> SourceReader:
    """``reader(name)`` for a source schema kept in a catalog database or as
    ``{root}/{name}`` datasets. ``flag`` is what the source calls its
    soft-delete flag, ``metadata`` names columns of its replication to drop."""
    def read(name: str) -> DataFrame:
        if root is not None:
            df = scan(spark, f"{root.rstrip('/')}/{name}", fmt)
        else:
            df = scan(spark, f"{database}.{name}" if database else name, fmt)
        return df.drop(*metadata).withColumnRenamed(flag, conf.DELETED_FLAG)
    return read


def is_missing(error: AnalysisException) -> bool:
    """Whether an analysis error only says that a path or table is not there."""
    return error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def _path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def path_has_data(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True when ``path`` holds a readable dataset with at least one row.
    Errors other than a missing path, or one without any file, are raised."""
    if not _path_exists(spark, path):
        return False
    try:
        return not spark.read.format(fmt).load(path).isEmpty()
    except AnalysisException as error:
        if is_missing(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return False
        raise
