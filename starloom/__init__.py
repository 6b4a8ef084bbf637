"""starloom: a PySpark warehouse loader.

Change-tracked operational tables in, star schema out: soft-delete aware
reads, staged dimensions with denormalized lookups, type-2 dimension history
with surrogate keys, watermark landing, and a keyed sales fact with
dimension lookups on the current or as-of version. Every operator is a
function from DataFrames to DataFrames.
"""

__version__ = "0.1.0"
