"""Column-level operators: projection with aliases, schema conformance,
suffix renames and metadata drops. All are projections (no job)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import conf


def project(df: DataFrame, mapping: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Select columns; a mapping is ``{output_name: input_name}``."""
    if isinstance(mapping, Mapping):
        return df.select(*[F.col(src).alias(out) for out, src in mapping.items()])
    return df.select(*mapping)


def conform_columns(df: DataFrame, template: DataFrame | Sequence[str]) -> DataFrame:
    """Project ``df`` onto the template's column list (order included).
    Extra columns are dropped; missing ones raise with their names."""
    names = list(template.columns if isinstance(template, DataFrame) else template)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for conformance: {missing}")
    return df.select(*names)


def rename_suffix(df: DataFrame, suffix: str, append: bool = True) -> DataFrame:
    """Append ``suffix`` to every column, or strip it where a name ends with
    it (never mid-name)."""
    if append:
        names = [c + suffix for c in df.columns]
    else:
        names = [c.removesuffix(suffix) for c in df.columns]
    return df.toDF(*names)


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the named columns; absent names are ignored."""
    return df.drop(*list(cols))


def drop_metadata(df: DataFrame, cols: Iterable[str] = (conf.DELETED_FLAG,)) -> DataFrame:
    return drop_columns(df, cols)
