"""SCD2: classification, merge, the reference quirks and the properties of
SURVEY section 5."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom import conf
from starloom.operators import scd2

SCHEMA = "k int, a string, b string"
TRACKED = ("a", "b")
OPEN = dt.date(9999, 12, 31)


def history(spark, rows):
    """rows: (k, a, b, sk, eff, exp, flag)"""
    return spark.createDataFrame(rows, SCHEMA + ", sk_id long, effective_date date, "
                                               "expiration_date date, current_flag boolean")


def merged_rows(df):
    return sorted((r.k, r.a, r.b, r.sk_id, r.effective_date, r.expiration_date, r.current_flag)
                  for r in df.collect())


D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def test_initial_load_keys_in_key_order(spark):
    cur = spark.createDataFrame([(3, "c", None), (1, "a", "x")], SCHEMA)
    out = scd2.scd2_initial(cur, "k", "2024-01-01")
    assert out.columns == ["k", "a", "b", *conf.SCD2_COLUMNS]
    assert merged_rows(out) == [(1, "a", "x", 1, D1, OPEN, True), (3, "c", None, 2, D1, OPEN, True)]


def test_duplicate_natural_key_fails_with_count(spark):
    cur = spark.createDataFrame([(1, "a", None), (1, "b", None), (None, "x", None), (None, "y", None)], SCHEMA)
    with pytest.raises(ValueError, match="2 values repeat"):
        scd2.scd2_initial(cur, "k", "2024-01-01")


def test_merge_all_actions_and_key_continuation(spark):
    hist = history(spark, [
        (1, "a", "x", 1, D1, OPEN, True),          # unchanged
        (2, "b", "x", 2, D1, OPEN, True),          # updated
        (3, "c", "x", 3, D1, OPEN, True),          # deleted
        (9, "z", "x", 7, D1, dt.date(2024, 1, 15), False),  # closed earlier, re-inserted
    ])
    cur = spark.createDataFrame([(1, "a", "x"), (2, "B", "x"), (9, "z", "x"), (5, "e", None)], SCHEMA)
    out = scd2.scd2_merge(hist, cur, "k", TRACKED, "2024-02-01", with_action=True)
    got = sorted((r.k, r.sk_id, r.current_flag, r.expiration_date, r.action) for r in out.collect())
    assert got == [
        (1, 1, True, OPEN, "NOCHANGE"),
        (2, 2, False, D2, "UPDATE"),
        (2, 10, True, OPEN, "UPDATE"),     # updates after inserts
        (3, 3, False, D2, "DELETE"),
        (5, 8, True, OPEN, "INSERT"),      # inserts first, key order, after max_sk = 7
        (9, 7, False, dt.date(2024, 1, 15), None),
        (9, 9, True, OPEN, "INSERT"),      # Q11: deleted then seen again is an insert
    ]


def test_updates_only_still_get_keys(spark):
    """Q2: with no insert the reference gave updated rows a NULL key."""
    hist = history(spark, [(1, "a", None, 4, D1, OPEN, True)])
    cur = spark.createDataFrame([(1, "A", None)], SCHEMA)
    out = scd2.scd2_merge(hist, cur, "k", TRACKED, "2024-02-01")
    assert sorted(r.sk_id for r in out.collect()) == [4, 5]


def test_null_key_matches_null_key(spark):
    """Q3: a NULL natural key on both sides is the same key (no spurious
    DELETE + INSERT)."""
    hist = history(spark, [(None, "a", None, 1, D1, OPEN, True)])
    cur = spark.createDataFrame([(None, "a", None)], SCHEMA)
    out = scd2.scd2_merge(hist, cur, "k", TRACKED, "2024-02-01", with_action=True)
    assert [(r.sk_id, r.action) for r in out.collect()] == [(1, "NOCHANGE")]


def test_fingerprint_collision_is_caught_by_default(spark):
    """Q1: ('ab','c') -> ('a','bc') and (NULL,'a') -> ('a',NULL) are changes."""
    hist = history(spark, [(1, "ab", "c", 1, D1, OPEN, True), (2, None, "a", 2, D1, OPEN, True)])
    cur = spark.createDataFrame([(1, "a", "bc"), (2, "a", None)], SCHEMA)
    safe = scd2.scd2_merge(hist, cur, "k", TRACKED, "2024-02-01", with_action=True)
    assert {r.action for r in safe.collect()} == {"UPDATE"}
    plain = scd2.scd2_merge(hist, cur, "k", TRACKED, "2024-02-01", fingerprint="plain",
                            with_action=True)
    assert {r.action for r in plain.collect()} == {"NOCHANGE"}


def test_same_day_change_gives_empty_interval(spark):
    """Q10: a change on the open row's effective date closes it the same day."""
    hist = history(spark, [(1, "a", None, 1, D2, OPEN, True)])
    cur = spark.createDataFrame([(1, "b", None)], SCHEMA)
    out = scd2.scd2_merge(hist, cur, "k", TRACKED, "2024-02-01")
    closed = [r for r in out.collect() if not r.current_flag][0]
    assert closed.effective_date == closed.expiration_date == D2


def test_empty_current_closes_everything_and_empty_history_opens_everything(spark):
    hist = history(spark, [(1, "a", None, 1, D1, OPEN, True)])
    empty = spark.createDataFrame([], SCHEMA)
    out = scd2.scd2_merge(hist, empty, "k", TRACKED, "2024-02-01")
    assert [(r.current_flag, r.expiration_date) for r in out.collect()] == [(False, D2)]
    no_hist = history(spark, [])
    cur = spark.createDataFrame([(2, "b", None), (1, "a", None)], SCHEMA)
    out = scd2.scd2_merge(no_hist, cur, "k", TRACKED, "2024-02-01")
    assert sorted((r.k, r.sk_id) for r in out.collect()) == [(1, 1), (2, 2)]


def test_properties_on_the_two_batch_scenario(spark):
    from conftest import SF_SMALL
    from starloom.plans import scenarios
    from starloom.sources.fixtures import FixtureSource
    src = FixtureSource(spark, SF_SMALL)
    hist = scenarios.customer_history(src)
    b2 = scenarios.customer_batch2(src)
    out = scenarios.customer_merged(src, with_action=True).cache()
    try:
        counts = {r.action: r["count"] for r in out.groupBy("action").count().collect()}
        assert counts == {None: 5, "NOCHANGE": 90, "INSERT": 12, "DELETE": 12, "UPDATE": 32}
        # one open row per key, sk unique and non-null
        assert out.filter("current_flag").groupBy("customerid").count().filter("count > 1").count() == 0
        assert out.filter("sk_id is null").count() == 0
        assert out.select("sk_id").distinct().count() == out.count()
        # open rows equal staging on key + tracked columns
        cols = ["customerid", *scenarios.CUSTOMER.tracked]
        assert out.filter("current_flag").select(*cols).exceptAll(b2.select(*cols)).count() == 0
        assert b2.select(*cols).exceptAll(out.filter("current_flag").select(*cols)).count() == 0
        # validity intervals of a key never overlap
        a, b = out.alias("a"), out.alias("b")
        overlap = a.join(b, (F.col("a.customerid") == F.col("b.customerid"))
                         & (F.col("a.sk_id") < F.col("b.sk_id"))
                         & (F.col("a.effective_date") < F.col("b.expiration_date"))
                         & (F.col("b.effective_date") < F.col("a.expiration_date")))
        assert overlap.count() == 0
        # the row-count law
        closed = hist.filter("not current_flag").count()
        assert out.count() == closed + counts["NOCHANGE"] + counts["INSERT"] + counts["DELETE"] \
            + counts["UPDATE"]
    finally:
        out.unpersist()


def test_rerunning_the_same_batch_changes_nothing(spark):
    hist = history(spark, [(1, "a", None, 1, D1, OPEN, True), (2, "b", None, 2, D1, OPEN, True)])
    cur = spark.createDataFrame([(1, "A", None), (3, "c", None)], SCHEMA)
    once = scd2.scd2_merge(hist, cur, "k", TRACKED, "2024-02-01")
    once = spark.createDataFrame(once.collect(), once.schema)
    twice = scd2.scd2_merge(once, cur, "k", TRACKED, "2024-02-01")
    assert merged_rows(once) == merged_rows(twice)


def test_the_merge_joins_once(spark):
    """The classified rows are stored: what is left of the plan reads them."""
    from starloom.plans import scenarios
    from starloom.sources.fixtures import FixtureSource
    from conftest import SF_SMALL
    plan = scenarios.customer_merged(FixtureSource(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "Window [row_number" in plan


from hypothesis import HealthCheck, given, settings, strategies as st  # noqa: E402

_keys = st.lists(st.integers(0, 12), unique=True, max_size=8)
_vals = st.sampled_from(["x", "y", None])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(hist_keys=_keys, cur_keys=_keys, hv=st.lists(_vals, min_size=8, max_size=8),
       cv=st.lists(_vals, min_size=8, max_size=8), closed=st.lists(st.booleans(), min_size=8, max_size=8))
def test_merge_properties_random(spark, hist_keys, cur_keys, hv, cv, closed):
    rows = [(k, hv[i], None, i + 1, D1, OPEN if not closed[i] else dt.date(2024, 1, 10), not closed[i])
            for i, k in enumerate(hist_keys)]
    hist = history(spark, rows)
    cur = spark.createDataFrame([(k, cv[i], None) for i, k in enumerate(cur_keys)], SCHEMA)
    out = scd2.scd2_merge(hist, cur, "k", TRACKED, "2024-02-01", with_action=True).collect()
    open_rows = [r for r in out if r.current_flag]
    # one open row per key, exactly the current rows
    assert sorted((r.k, r.a) for r in open_rows) == sorted((k, cv[i]) for i, k in enumerate(cur_keys))
    # keys unique, never NULL, new ones dense after the history's max
    sks = [r.sk_id for r in out]
    assert None not in sks and len(set(sks)) == len(sks)
    new = sorted(r.sk_id for r in out if r.action in ("INSERT", "UPDATE") and r.current_flag)
    start = max([i + 1 for i in range(len(hist_keys))], default=0)
    assert new == list(range(start + 1, start + 1 + len(new)))
    # row-count law
    n = {a: sum(1 for r in out if r.action == a) for a in ("NOCHANGE", "INSERT", "DELETE", "UPDATE")}
    assert len(out) == sum(closed[:len(hist_keys)]) + n["NOCHANGE"] + n["INSERT"] + n["DELETE"] + n["UPDATE"]
    # merging the same batch again changes nothing
    again = scd2.scd2_merge(spark.createDataFrame([tuple(r)[:-1] for r in out], hist.schema), cur, "k",
                            TRACKED, "2024-02-01").collect()
    assert sorted(map(tuple, again), key=str) == sorted((tuple(r)[:-1] for r in out), key=str)
