"""Scalar column functions (all built-in Spark expressions, codegen'd)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom import conf

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(*parts: ColumnOrName) -> Column:
    """Space-joined name; NULL parts are skipped, all-NULL gives ''."""
    return F.concat_ws(" ", *[_col(p) for p in parts])


def row_fingerprint(cols: Sequence[ColumnOrName]) -> Column:
    """md5 of the parts concatenated with no delimiter, NULLs skipped.

    Faithful form: ('ab','c') and ('a','bc') collide, as do (NULL,'a') and
    ('a',NULL). Use :func:`row_fingerprint_safe` for change detection."""
    if not cols:
        return F.md5(F.lit(conf.EMPTY_FINGERPRINT_INPUT))
    return F.md5(F.concat_ws("", *[_col(c).cast("string") for c in cols]))


def row_fingerprint_safe(cols: Sequence[ColumnOrName]) -> Column:
    """md5 of an unambiguous encoding: each part is ``<length>:<text>`` and
    NULL is ``~``, so no two different rows share the input string."""
    if not cols:
        return F.md5(F.lit(conf.EMPTY_FINGERPRINT_INPUT))
    parts = []
    for c in cols:
        text = _col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text),
                                F.lit(conf.FINGERPRINT_NULL)))
    return F.md5(F.concat_ws("", *parts))


def surrogate_hash(cols: Sequence[ColumnOrName]) -> Column:
    """Composite hash key: md5 of the string forms joined by '-', NULL parts
    replaced by a fixed sentinel."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(conf.SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(conf.SURROGATE_SEPARATOR, *parts))


def decode_order_status(code: ColumnOrName) -> Column:
    """CASE decode of the order status code with a default name."""
    c = _col(code)
    expr = None
    for value, name in conf.ORDER_STATUS_NAMES.items():
        expr = F.when(c == value, name) if expr is None else expr.when(c == value, name)
    return expr.otherwise(conf.ORDER_STATUS_DEFAULT)


def revenue(price: ColumnOrName, quantity: ColumnOrName) -> Column:
    """price x quantity as decimal(18,2); overflow raises under ANSI mode."""
    return (_col(price) * _col(quantity)).cast("decimal(18,2)")


def format_date(c: ColumnOrName, fmt: str = conf.DATE_FORMAT) -> Column:
    return F.date_format(_col(c), fmt)


def to_date(c: ColumnOrName) -> Column:
    return _col(c).cast("date")


def date_literal(value) -> Column:
    """A date given as 'yyyy-MM-dd', a date or a Column."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")
