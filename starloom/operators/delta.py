"""Staged tables kept by the changes of their sources.

A staged table is a driving table with lookups. The change of such a join is (changed
driving rows joined with the parents) plus (driving rows whose parent changed, at
any distance: a renamed country reaches the states that name it and, through them,
every address). So from the changed rows of each source:

1. changed parent keys are carried down the lookups, farthest parent first, each by
   one semi join over two columns (key and foreign key) of the child table;
2. the driving rows reached are read by key, their parents by the foreign keys that
   those rows hold, and the table's own builder runs on these few rows;
3. the staged table's rows of the reached keys give way to the rebuilt ones; a
   deleted driving row just leaves.

Nothing else of the sources passes a join or a shuffle: the sets of keys are written
once, counted, and broadcast when they are under the bound for broadcasts. The cost of
a day is that of scanning the key columns, not of rebuilding the table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import conf
from starloom.operators.lookup import checked_side
from starloom.operators.scd2 import open_rows, scd2_merge
from starloom.operators.keys import max_surrogate_key
from starloom.session import materialize
from starloom.sources.tables import SourceReader

_K = "_delta_key"


@dataclass(frozen=True)
class Parent:
    """A looked-up table: rows of ``child`` name its ``key`` in ``foreign_key``."""
    table: str
    key: str
    child: str
    foreign_key: str


@dataclass(frozen=True)
class Lineage:
    """Where a staged table's rows come from: the driving table and its parents,
    nearest first. ``key`` is the key of both the driving and the staged table."""
    driver: str
    key: str
    parents: tuple[Parent, ...]

    def key_of(self, table: str) -> str:
        return self.key if table == self.driver else next(p.key for p in self.parents if p.table == table)


@dataclass
class StageDelta:
    """What a day changes in a staged table: the keys reached, and the rows that
    these keys have now (a key without a row has left)."""
    key: str
    keys: DataFrame
    n_keys: int
    rows: DataFrame


def _semi(df: DataFrame, column: str, keys: DataFrame, n: int) -> DataFrame:
    """Rows of df whose column is among the n keys, broadcast if under the bound."""
    side = checked_side(keys, True, n)
    return df.join(side, F.col(column).eqNullSafe(side[_K]), "left_semi")


def reached_keys(lineage: Lineage, read: SourceReader, changed: SourceReader) -> tuple[DataFrame, int]:
    """Keys of the driving rows that a change reaches, and their number."""
    reached: dict[str, DataFrame] = {}
    for parent in reversed(lineage.parents):
        keys = changed(parent.table).select(F.col(parent.key).alias(_K))
        if parent.table in reached:
            keys = keys.union(reached[parent.table])
        # A null foreign key names no parent.
        keys = materialize(keys.filter(F.col(_K).isNotNull()).distinct())
        child_key = lineage.key_of(parent.child)
        rows = _semi(read(parent.child).select(F.col(child_key).alias("_child"), parent.foreign_key),
                     parent.foreign_key, keys, keys.count()).select(F.col("_child").alias(_K))
        reached[parent.child] = reached[parent.child].union(rows) if parent.child in reached else rows
    keys = changed(lineage.driver).select(F.col(lineage.key).alias(_K))
    if lineage.driver in reached:
        keys = keys.union(reached[lineage.driver])
    keys = materialize(keys.distinct())
    return keys, keys.count()


def stage_delta(build: Callable[[SourceReader], DataFrame], lineage: Lineage, read: SourceReader,
                changed: SourceReader) -> StageDelta:
    """The change of the staged table that ``build`` makes. ``read`` gives the sources
    as they are now, ``changed`` the rows of a source that were inserted, updated or
    (flag set) deleted since the table was staged."""
    keys, n = reached_keys(lineage, read, changed)
    above = {p.table: p for p in lineage.parents}

    def scoped(name: str) -> DataFrame:
        if name == lineage.driver:
            return _semi(read(name), lineage.key, keys, n)
        if name not in above:
            raise KeyError(f"{name!r} is not in the lineage of {lineage.driver!r}")
        parent = above[name]
        # There are no more foreign keys than rows that hold them.
        wanted = scoped(parent.child).select(F.col(parent.foreign_key).alias(_K)).filter(F.col(_K).isNotNull()).distinct()
        return _semi(read(name), parent.key, wanted, n)
    return StageDelta(lineage.key, keys, n, build(scoped))


def apply_delta(staged: DataFrame, delta: StageDelta) -> DataFrame:
    """The staged table after the change."""
    side = checked_side(delta.keys, True, delta.n_keys)
    kept = staged.join(side, F.col(delta.key).eqNullSafe(side[_K]), "left_anti")
    return kept.unionByName(delta.rows.select(*staged.columns))


def scd2_merge_delta(history: DataFrame, delta: StageDelta, tracked, load_date, max_sk: int | None = None,
                     fingerprint: str = "safe") -> DataFrame:
    """The SCD2 merge of a staged table's change: only open versions of the keys
    reached meet the rebuilt rows. All other history passes untouched, so the result
    equals a merge with the whole staged table. ``max_sk``, when the caller keeps it,
    saves a scan of the history."""
    if max_sk is None:
        max_sk = max_surrogate_key(history)
    side = checked_side(delta.keys, True, delta.n_keys)
    met = F.col(delta.key).eqNullSafe(side[_K])
    is_open = F.coalesce(F.col(conf.CURRENT_COL) == F.lit(True), F.lit(False))
    merged = scd2_merge(open_rows(history).join(side, met, "left_semi"), delta.rows, delta.key, tracked,
                        load_date, fingerprint=fingerprint, max_sk=max_sk)
    passed = history.filter(~is_open).unionByName(history.filter(is_open).join(side, met, "left_anti"))
    return passed.select(*merged.columns).unionByName(merged)
