"""CDC reads, column operators, lookups, keys and upsert on literal frames."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from starloom.operators import cdc, columns, keys, lookup, upsert


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def plan_text(df, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


# -- cdc -------------------------------------------------------------------------

def test_live_rows_drops_deleted_and_null_flags(spark):
    df = spark.createDataFrame([(1, False), (2, True), (3, None)], "id int, _deleted boolean")
    assert [r.id for r in cdc.live_rows(df).collect()] == [1]


def test_live_rows_filter_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, False), (2, True)], "id int, _deleted boolean").write.parquet(path)
    plan = plan_text(cdc.live_rows(spark.read.parquet(path)))
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    assert "_deleted" in pushed


def test_after_watermark_strict_and_inclusive(spark):
    df = spark.createDataFrame([(1, ts("2001-01-01")), (2, ts("2001-01-02")), (3, ts("2001-01-03"))],
                               "id int, m timestamp_ntz")
    wm = ts("2001-01-02")
    assert [r.id for r in cdc.after_watermark(df, "m", wm, strict=True).collect()] == [3]
    assert [r.id for r in cdc.after_watermark(df, "m", wm, strict=False).collect()] == [2, 3]
    assert cdc.after_watermark(df, "m", None).count() == 3


def test_high_watermark_over_live_rows_and_empty(spark):
    df = spark.createDataFrame([(ts("2001-01-01"), False), (ts("2001-01-05"), True)],
                               "m timestamp_ntz, _deleted boolean")
    assert cdc.high_watermark(df, "m") == ts("2001-01-01")
    assert cdc.high_watermark(df, "m", flag=None) == ts("2001-01-05")
    assert cdc.high_watermark(df.limit(0), "m") is None
    assert cdc.is_empty(df.limit(0)) and not cdc.is_empty(df)


def test_newest_per_key_with_deterministic_ties(spark):
    df = spark.createDataFrame(
        [(1, ts("2001-01-01"), "a"), (1, ts("2001-01-03"), "b"), (1, ts("2001-01-03"), "c"),
         (2, ts("2001-01-02"), "x")], "k int, m timestamp_ntz, v string")
    got = sorted((r.k, r.v) for r in cdc.newest_per_key(df, ["k"], ["m"]).collect())
    assert got == [(1, "c"), (2, "x")]


def test_newest_per_key_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a")], "k int, m int, v string")
    plan = plan_text(cdc.newest_per_key(df, ["k"], ["m"]))
    assert "partial_max" in plan


# -- columns ----------------------------------------------------------------------

def test_conform_columns_orders_and_reports_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c int, a int, extra int")
    assert columns.conform_columns(df, ["a", "c"]).columns == ["a", "c"]
    with pytest.raises(ValueError, match="'b'"):
        columns.conform_columns(df, ["a", "b"])


def test_rename_suffix_strips_only_at_the_end(spark):
    df = spark.createDataFrame([(1, 2)], "id_history int, x_history_history int")
    back = columns.rename_suffix(df, "_history", append=False)
    assert back.columns == ["id", "x_history"]
    assert columns.rename_suffix(back, "_c").columns == ["id_c", "x_history_c"]


def test_drop_metadata_ignores_absent_names(spark):
    df = spark.createDataFrame([(1, False)], "id int, _deleted boolean")
    assert columns.drop_metadata(df).columns == ["id"]


# -- lookups ----------------------------------------------------------------------

def test_lookup_chain_keeps_rows_with_missing_parents(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, pid int")
    parent = spark.createDataFrame([(10, "p10", 100)], "pid int, name string, gid int")
    grand = spark.createDataFrame([(100, "g100")], "gid int, name string")
    df = lookup.lookup(child, parent, "pid", {"pname": "name", "_gid": "gid"})
    df = lookup.lookup(df, grand, ("_gid", "gid"), {"gname": "name"}).drop("_gid")
    got = sorted((r.id, r.pname, r.gname) for r in df.collect())
    assert got == [(1, "p10", "g100"), (2, None, None), (3, None, None)]


def test_checked_broadcast_falls_back_when_too_big(spark):
    child = spark.createDataFrame([(1,)], "id int")
    dim = spark.range(10).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("v"))
    spark.conf.set("starloom.join.broadcastMaxBytes", "160")
    try:
        plan = plan_text(lookup.lookup(child, dim, "id", ["v"], broadcast=True), "extended")
        assert "strategy=broadcast" not in plan
    finally:
        spark.conf.unset("starloom.join.broadcastMaxBytes")
    plan = plan_text(lookup.lookup(child, dim, "id", ["v"], broadcast=True), "extended")
    assert "strategy=broadcast" in plan


def _dim(spark):
    return spark.createDataFrame(
        [(1, 11, dt.date(2024, 1, 1), dt.date(2024, 2, 1), False),
         (1, 12, dt.date(2024, 2, 1), dt.date(2024, 2, 1), False),   # empty interval (same-day)
         (1, 13, dt.date(2024, 2, 1), dt.date(9999, 12, 31), True)],
        "k int, sk_id long, effective_date date, expiration_date date, current_flag boolean")


def test_dim_lookup_versions(spark):
    facts = spark.createDataFrame([(1, dt.date(2024, 1, 15)), (1, dt.date(2024, 2, 1)), (2, dt.date(2024, 1, 1))],
                                  "k int, d date")
    cur = lookup.dim_lookup(facts, _dim(spark), "k", "k", "key", version="current")
    assert sorted((r.d.isoformat(), r.key) for r in cur.filter("k = 1").collect()) == \
        [("2024-01-15", 13), ("2024-02-01", 13)]
    asof = lookup.dim_lookup(facts, _dim(spark), "k", "k", "key", version="as_of", at="d")
    got = sorted((r.k, r.d.isoformat(), r.key) for r in asof.collect())
    assert got == [(1, "2024-01-15", 11), (1, "2024-02-01", 13), (2, "2024-01-01", None)]
    assert lookup.dim_lookup(facts, _dim(spark), "k", "k", "key", version="all").count() == 7


# -- surrogate keys -----------------------------------------------------------------

def test_surrogate_keys_dense_ordered_with_start(spark):
    df = spark.createDataFrame([(5,), (1,), (None,), (3,)], "k int")
    got = [(r.k, r.sk_id) for r in keys.assign_surrogate_keys(df, "k", start=10).orderBy("sk_id").collect()]
    assert got == [(None, 11), (1, 12), (3, 13), (5, 14)]


@pytest.mark.parametrize("keytype", ["long", "string", "date"])
def test_many_ranges_number_like_one(spark, small_keys, keytype):
    n = 200
    base = spark.range(n).select(((F.col("id") * 7919) % 1000).alias("k"), (F.col("id") % 2).alias("seg"))
    if keytype == "string":
        base = base.select(F.format_string("k%05d", "k").alias("k"), "seg")
    elif keytype == "date":
        base = base.select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("k").cast("int")).alias("k"), "seg")
    null_row = spark.createDataFrame([(None, 0)], f"k {base.schema['k'].dataType.simpleString()}, seg long")
    base = base.unionByName(null_row)  # a NULL key
    ranged = keys.assign_surrogate_keys(base, "k", start=100, segment_col="seg")
    spark.conf.unset("starloom.keys.rowsPerRange")
    single = keys.assign_surrogate_keys(base, "k", start=100, segment_col="seg")
    a = sorted((r.seg, str(r.k), r.sk_id) for r in ranged.collect())
    b = sorted((r.seg, str(r.k), r.sk_id) for r in single.collect())
    assert a == b
    assert sorted(x[2] for x in a) == list(range(101, 101 + n + 1))


def test_max_surrogate_key_of_empty_table_is_zero(spark):
    assert keys.max_surrogate_key(spark.createDataFrame([], "sk_id long")) == 0


# -- upsert -------------------------------------------------------------------------

def test_merge_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c"), (3, "d")], "k int, v string")
    got = sorted(tuple(r) for r in upsert.merge_upsert(target, source, "k", order_cols=["v"]).collect())
    assert got == [(1, "a"), (2, "B"), (3, "d")]


def test_apply_changes_deletes_and_updates(spark):
    target = spark.createDataFrame([(1, "a", ts("2001-01-01")), (2, "b", ts("2001-01-01"))],
                                   "k int, v string, m timestamp_ntz")
    changes = spark.createDataFrame(
        [(1, "a2", ts("2001-01-02"), False), (2, "b2", ts("2001-01-02"), False),
         (2, "b2", ts("2001-01-03"), True), (3, "c", ts("2001-01-02"), None),
         (4, "d", ts("2001-01-02"), False)],
        "k int, v string, m timestamp_ntz, _deleted boolean")
    got = sorted((r.k, r.v) for r in upsert.apply_changes(target, changes, "k", ["m"]).collect())
    assert got == [(1, "a2"), (4, "d")]
    # applying the same change set twice changes nothing
    once = upsert.apply_changes(target, changes, "k", ["m"])
    twice = upsert.apply_changes(once, changes, "k", ["m"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@pytest.mark.parametrize("keytype", ["long", "string"])
def test_parallel_keys_are_the_same_when_recomputed(spark, small_keys, keytype):
    """A recomputed plan (as after a lost executor) gives the same keys: the
    range bounds and offsets are fixed values (numeric keys), or the ranged
    rows were checkpointed (string keys)."""
    base = spark.range(300).select(((F.col("id") * 7919) % 1000).alias("k"))
    if keytype == "string":
        base = base.select(F.format_string("k%05d", "k").alias("k"))
    keyed = keys.assign_surrogate_keys(base.repartition(7), "k")
    first = sorted((r.k, r.sk_id) for r in keyed.collect())
    second = sorted((r.k, r.sk_id) for r in keyed.collect())
    assert first == second and [s for _, s in first] == list(range(1, 301))
