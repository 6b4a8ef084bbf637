"""Constants and tunables.

Fixed values are the ones a warehouse built by this package must share with
the pipeline it replaces; tunables are read from the Spark session so a
cluster can size them without code changes.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values (must not change: results depend on them)
# ---------------------------------------------------------------------------
# Open end of an SCD2 validity interval.
OPEN_END_DATE = "9999-12-31"
# Text form of validity dates when a caller asks for strings.
DATE_FORMAT = "yyyy-MM-dd"
# Order status codes and their names; every other code (and NULL) is the default.
ORDER_STATUS_NAMES = {
    1: "in_process",
    2: "approved",
    3: "backordered",
    4: "rejected",
    5: "shipped",
    6: "cancelled",
}
ORDER_STATUS_DEFAULT = "no_status"
# Composite surrogate hash: parts joined by this separator, NULL parts replaced
# by the sentinel (keys built from non-null parts are plain md5("a-b")).
SURROGATE_SEPARATOR = "-"
SURROGATE_NULL = "_surrogate_key_null_"
# Row fingerprint, safe form: each part is "<length>:<text>", NULL is "~".
FINGERPRINT_NULL = "~"
# Fingerprint of a row with no tracked columns.
EMPTY_FINGERPRINT_INPUT = "1"

# Soft-delete flag of source rows; sources that name it differently rename it
# with ``table_reader(flag=...)``.
DELETED_FLAG = "_deleted"

# SCD2 bookkeeping columns, in output order.
SK_COL = "sk_id"
EFFECTIVE_COL = "effective_date"
EXPIRATION_COL = "expiration_date"
CURRENT_COL = "current_flag"
SCD2_COLUMNS = (SK_COL, EFFECTIVE_COL, EXPIRATION_COL, CURRENT_COL)

# SCD2 actions.
NOCHANGE, INSERT, UPDATE, DELETE = "NOCHANGE", "INSERT", "UPDATE", "DELETE"

# ---------------------------------------------------------------------------
# Tunables (spark conf key -> default)
# ---------------------------------------------------------------------------
# Target rows per key range when numbering in parallel.
SK_ROWS_PER_RANGE = ("starloom.keys.rowsPerRange", 1_000_000)
# A lookup side is broadcast only when its rows times their estimated width are
# at most this many bytes.
BROADCAST_MAX_BYTES = ("starloom.join.broadcastMaxBytes", 200 << 20)
# The hash tables of the sides that one plan broadcasts are built in the driver, together:
# they get at most this share of its heap.
BROADCAST_HEAP_SHARE = ("starloom.join.broadcastHeapShare", 0.5)
# Landed order tables are partitioned by blocks of this many order ids.
ORDER_BLOCK_SIZE = ("starloom.landing.orderBlockSize", 1_000_000)
# Re-read this many seconds before the landing watermark (rows replicated
# late with older timestamps). Safe: changes are applied by key, and the
# source holds each row's latest version.
LANDING_LOOKBACK_SECONDS = ("starloom.landing.lookbackSeconds", 0)
# Buckets that the keys of a dimension are dealt over when sides are compared by digests;
# open versions are stored by bucket, so a bucket should hold some ten thousand keys. A
# stored dimension keeps the number it was created with.
DIGEST_BUCKETS = ("starloom.scd2.digestBuckets", 64)
# Buckets of the order id in which lines and headers are stored for a join without a
# shuffle, and how many lines make an order hot (stored apart).
ORDER_BUCKETS = ("starloom.landing.orderBuckets", 64)
HOT_ORDER_ROWS = ("starloom.landing.hotOrderRows", 1_000_000)
# Lines of one key that an as-of lookup sorts in one range.
AS_OF_ROWS = ("starloom.asOf.rowsPerRange", 1_000_000)


def tunable(spark: SparkSession, setting: tuple[str, int | float]) -> int | float:
    key, default = setting
    value = spark.conf.get(key, None)
    if value is None:
        return default
    return type(default)(value)
