"""Keyed upsert and change application without a table-format MERGE.

``target`` keeps the rows whose key the change set does not touch; the change
set (reduced to one row per key) is appended. The anti join reads only the
key columns of the change set; Spark broadcasts that side when its estimated
size allows, otherwise both sides shuffle on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starloom import conf
from starloom.operators.cdc import live_rows, newest_per_key
from starloom.session import materialize


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def merge_upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str],
                 order_cols: Sequence[str] | None = None, fixed: bool = False) -> DataFrame:
    """Rows of ``target`` whose key is absent from ``source``, plus
    ``source``. With ``order_cols`` the source is first reduced to its
    greatest row per key (remaining columns break ties). ``fixed`` says that the
    source comes from stored rows by little work: it is then read twice rather than
    written once more."""
    keys = _keys(key)
    src = newest_per_key(source, keys, order_cols) if order_cols else source
    if not fixed:
        # Read twice (keys removed, rows added): computed once.
        src = materialize(src)
    untouched = target.join(src.select(*keys), keys, "left_anti")
    return untouched.unionByName(src.select(*target.columns))


def apply_changes(target: DataFrame, changes: DataFrame, key: str | Sequence[str],
                  order_cols: Sequence[str], flag: str = conf.DELETED_FLAG) -> DataFrame:
    """Apply a change set with soft deletes: the newest change per key wins;
    a live newest row (flag false) replaces the target's rows for that key, a
    deleted one (flag true or NULL) removes them."""
    keys = _keys(key)
    newest = materialize(newest_per_key(changes, keys, order_cols))
    untouched = target.join(newest.select(*keys), keys, "left_anti")
    arriving = live_rows(newest, flag).select(*target.columns)
    return untouched.unionByName(arriving)

