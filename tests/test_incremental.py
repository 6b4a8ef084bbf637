"""Operators that keep tables by changes: each against the rebuild it replaces, and the
plan or the rows that make it worth having."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from starloom import conf
from starloom.operators import as_of, delta, evolve, home, scd2, scd2_digest, scd2_log, support
from starloom.operators.lookup import dim_lookup
from starloom.plans import facts, repair
from starloom.plans.staging import LINEAGE, stg_dim_address
from starloom.sources import bucketed, statistics
from test_scd2 import OPEN, SCHEMA, TRACKED, history

D = dt.date


def rows_of(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan_of(df, run=False):
    if run:
        df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


# -- staging by changes ---------------------------------------------------------------

ADDRESS = "addressid long, city string, stateprovinceid int, _deleted boolean"
STATE = "stateprovinceid int, name string, countryregioncode string, _deleted boolean"
COUNTRY = "countryregioncode string, name string, _deleted boolean"


def sources(spark, addresses, states, countries):
    frames = {"person_address": spark.createDataFrame(addresses, ADDRESS),
              "person_stateprovince": spark.createDataFrame(states, STATE),
              "person_countryregion": spark.createDataFrame(countries, COUNTRY)}
    return frames.__getitem__


def address_delta(spark, before, after):
    """Delta staging between two states of the literal sources; the changed rows are
    those that differ."""
    old, new = sources(spark, *before), sources(spark, *after)
    change = delta.stage_delta(stg_dim_address, LINEAGE["stg_dim_address"], new,
                               lambda name: new(name).exceptAll(old(name)))
    return delta.apply_delta(stg_dim_address(old), change), stg_dim_address(new), change


BASE = ([(1, "a", 1, False), (2, "b", 1, False), (3, "c", 2, False), (4, "d", None, False), (5, "e", 9, False),
         (None, "n", 2, False)],
        [(1, "s1", "X", False), (2, "s2", "Y", False), (9, "s9", "X", True)],
        [("X", "cx", False), ("Y", "cy", False)])


@pytest.mark.parametrize("after, keys", [
    (BASE, set()),
    ((BASE[0][:1] + [(2, "B", 1, False), (7, "g", 2, False), (3, "c", 2, True)] + BASE[0][3:], BASE[1], BASE[2]), {2, 3, 7}),
    ((BASE[0], [(1, "S1", "X", False)] + BASE[1][1:], BASE[2]), {1, 2}),                       # a renamed state
    ((BASE[0], BASE[1], [("X", "CX", False), ("Y", "cy", False)]), {1, 2, 5}),                 # a renamed country, two hops
    ((BASE[0], [(1, "s1", "Y", False)] + BASE[1][1:], BASE[2]), {1, 2}),                       # a state that moved
    ((BASE[0], BASE[1][:2] + [(9, "s9", "X", False)], BASE[2]), {5}),                          # a parent restored
    ((BASE[0], BASE[1], [("X", "cx", True), ("Y", None, False)]), {1, 2, 3, 5, None}),         # a parent deleted
])
def test_delta_staging_equals_rebuild(spark, after, keys):
    got, want, change = address_delta(spark, BASE, after)
    assert rows_of(got) == rows_of(want)
    assert {r[0] for r in change.keys.collect()} == keys and change.n_keys == len(keys)


def test_delta_staging_reads_unchanged_sides_by_key(spark, tmp_path):
    read = sources(spark, *BASE)
    for name in ("person_address", "person_stateprovince", "person_countryregion"):
        read(name).write.parquet(f"{tmp_path}/{name}")
    stored = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    change = delta.stage_delta(stg_dim_address, LINEAGE["stg_dim_address"], stored,
                               lambda name: stored(name).filter(F.col("addressid") == 1 if name == "person_address" else F.lit(False)))
    plan = plan_of(change.rows)
    # Every scan goes straight into a semi join with the keys; nothing else is joined
    # or shuffled but sets of keys (their DISTINCT).
    assert plan.count("LeftSemi") >= 3 and "SortMergeJoin" not in plan
    assert rows_of(change.rows) == [(1, "a", "s1", "cx")]


def test_unknown_source_in_a_builder_fails(spark):
    read = sources(spark, *BASE)
    with pytest.raises(KeyError, match="lineage"):
        delta.stage_delta(lambda r: r("sales_store"), LINEAGE["stg_dim_address"], read, lambda n: read(n).limit(0))


def test_merge_of_a_delta_equals_merge_of_the_whole(spark):
    after = (BASE[0][1:3] + [(7, "g", 2, False)], [(1, "S1", "X", False)] + BASE[1][1:], BASE[2])
    after = ([(1, "a", 1, True)] + after[0] + BASE[0][3:], *after[1:])
    tracked = ("city_name", "state_name", "country_name")
    hist = scd2.scd2_initial(stg_dim_address(sources(spark, *BASE)), "addressid", "2024-01-01")
    _, now, change = address_delta(spark, BASE, after)
    got = delta.scd2_merge_delta(hist, change, tracked, "2024-02-01")
    assert rows_of(got) == rows_of(scd2.scd2_merge(hist, now, "addressid", tracked, "2024-02-01"))


# -- merge by bucket digests -------------------------------------------------------------

def random_history(spark, rng, n):
    rows = [(None if i == 0 else i, rng.choice("abc"), rng.choice(["x", None]), i + 1, D(2024, 1, 1), OPEN, True)
            for i in range(n) if rng.random() < 0.9]
    rows += [(i, "old", None, 1000 + i, D(2023, 1, 1), D(2024, 1, 1), False) for i in range(0, n, 7)]
    return history(spark, rows), [r for r in rows if r[6]]


@pytest.mark.parametrize("seed", range(3))
def test_digest_merge_equals_merge(spark, seed):
    rng = random.Random(seed)
    hist, opened = random_history(spark, rng, 60)
    now = [(k, a if rng.random() < 0.9 else a + "!", b) for k, a, b, *_ in opened if rng.random() < 0.95]
    now += [(200 + i, "new", None) for i in range(3)]
    cur = spark.createDataFrame(now, SCHEMA)
    stats = {}
    got = scd2_digest.scd2_merge_by_digest(hist, cur, "k", TRACKED, "2024-02-01", buckets=64, stats=stats, with_action=True)
    want = scd2.scd2_merge(hist, cur, "k", TRACKED, "2024-02-01", with_action=True)
    assert rows_of(got, *want.columns) == rows_of(want)
    assert 0 < stats["differing"] < 64


def test_digest_merge_without_rows(spark):
    hist, _ = random_history(spark, random.Random(1), 20)
    none = spark.createDataFrame([], SCHEMA)
    for h, c in ((hist, none), (hist.limit(0), none), (hist.limit(0), spark.createDataFrame([(1, "a", None)], SCHEMA))):
        got = scd2_digest.scd2_merge_by_digest(h, c, "k", TRACKED, "2024-02-01", buckets=8)
        assert rows_of(got) == rows_of(scd2.scd2_merge(h, c, "k", TRACKED, "2024-02-01"))


def test_untouched_buckets_are_not_read(spark, tmp_path):
    """One key changes: its bucket alone is read by the join."""
    rows = [(i, "a", None, i, D(2024, 1, 1), OPEN, True) for i in range(200)]
    path = f"{tmp_path}/h"
    scd2_digest.with_bucket(history(spark, rows), "k", 32).write.partitionBy(scd2_digest.BUCKET).parquet(path)
    stored = spark.read.parquet(path)
    cur = spark.createDataFrame([(i, "b" if i == 7 else "a", None) for i in range(200)], SCHEMA)
    digests = scd2_digest.bucket_digests(scd2.open_rows(stored), "k", TRACKED, 32)
    differ = scd2_digest.differing_buckets(digests, scd2_digest.bucket_digests(cur, "k", TRACKED, 32))
    assert len(differ) == 1
    touched = stored.filter(F.col(scd2_digest.BUCKET).isin(differ))
    assert "PartitionFilters: [key_bucket" in plan_of(touched).replace("isnotnull(key_bucket#", "key_bucket#")
    assert {f.split("key_bucket=")[1].split("/")[0] for f in touched.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} \
        == {str(differ[0])}
    got = scd2_digest.scd2_merge_by_digest(stored, cur, "k", TRACKED, "2024-02-01", buckets=32, digests=digests)
    want = scd2.scd2_merge(history(spark, rows), cur, "k", TRACKED, "2024-02-01")
    assert rows_of(got, *want.columns) == rows_of(want)


def test_digests_see_every_difference(spark):
    """Order does not matter; values swapped between keys, nulls and repeats do."""
    def digests(rows):
        return rows_of(scd2_digest.bucket_digests(spark.createDataFrame(rows, SCHEMA), "k", TRACKED, 1))
    base = digests([(1, "a", "b"), (2, "c", None)])
    assert base == digests([(2, "c", None), (1, "a", "b")])
    for other in ([(1, "c", None), (2, "a", "b")], [(1, "a", "b"), (2, None, "c")], [(1, "a", "b")],
                  [(1, "a", "b"), (2, "c", None), (2, "c", None)], [(1, "ab", ""), (2, "c", None)]):
        assert base != digests(other)


# -- co-located orders -------------------------------------------------------------------

def orders(spark, n=900, hot=300):
    lines = [(1 if i < hot else None if i % 50 == 0 else i % 97, i, i % 7, 2, "1.50") for i in range(n)]
    lines = spark.createDataFrame(lines, "salesorderid long, salesorderdetailid long, productid long, orderqty int, p string") \
        .select("salesorderid", "salesorderdetailid", "productid", "orderqty", F.col("p").cast("decimal(12,2)").alias("unitprice"))
    headers = [(i, i % 10, i % 4 or None, i % 10, i % 7, dt.datetime(2001, 1, 1 + i % 28)) for i in range(90)]
    headers = spark.createDataFrame(headers, "salesorderid long, customerid long, creditcardid long, shiptoaddressid long, "
                                             "status int, orderdate timestamp_ntz")
    return lines, headers


def dims(spark):
    dim = spark.range(10).select(F.col("id").alias("k"), (F.col("id") + 1).alias("sk_id"), F.lit(True).alias("current_flag"))
    return {name: dim.withColumnRenamed("k", key) for name, key in (
        ("dim_orderstatus", "order_status"), ("dim_creditcard", "creditcardid"), ("dim_product", "productid"),
        ("dim_address", "addressid"), ("dim_customer", "customerid"))}


@pytest.mark.parametrize("hot_rows, n_hot", [(100000, 0), (100, 1)])
def test_bucketed_fact(spark, tmp_path, hot_rows, n_hot):
    lines, headers = orders(spark)
    stored = bucketed.land_bucketed(spark, lines, headers, str(tmp_path), buckets=8, hot_rows=hot_rows)
    assert stored.n_hot == n_hot
    rows = stored.lines.count() + stored.hot_lines.count()
    assert rows == lines.count() and (stored.lines.filter("salesorderid = 1").count() == 0) == bool(n_hot)
    known = dict.fromkeys(dims(spark), 10)
    fact = facts.sales_fact_bucketed(stored, dims(spark), dim_rows=known)
    plan = plan_of(fact)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    assert rows_of(fact) == rows_of(facts.sales_fact(lines, headers, dims(spark)))
    joined = bucketed.join_lines(stored)
    assert "Exchange hashpartitioning" not in plan_of(joined)
    assert rows_of(joined, "salesorderdetailid", "customerid") == rows_of(lines.join(headers, "salesorderid"), "salesorderdetailid", "customerid")
    # The plain tables need the shuffle that the buckets save.
    assert "Exchange hashpartitioning" in plan_of(lines.join(headers.hint("merge"), "salesorderid"))


# -- as-of lookup in one pass ---------------------------------------------------------------

DIM = "k long, sk_id long, effective_date date, expiration_date date, current_flag boolean"


def versions(rng, keys, days):
    """Adjoining, interrupted and empty intervals."""
    out, sk = [], 0
    for k in keys:
        at = D(2000, 1, 1) + dt.timedelta(rng.randint(0, days // 3))
        for _ in range(rng.randint(0, 6)):
            end = at + dt.timedelta(rng.choice([0, 0, 1, 3, days // 2]))
            sk += 1
            out.append((k, sk, at, end, False))
            at = end + dt.timedelta(rng.choice([0, 0, 2]))
        out.append((k, sk + 1, at, OPEN, True))
        sk += 1
    out.append((None, sk + 1, D(1990, 1, 1), OPEN, True))
    return out


@pytest.mark.parametrize("per, seed", [(1000, 0), (25, 1), (7, 2), (1, 3)])
def test_as_of_pass_equals_equi_join(spark, per, seed):
    """Also with a hot key that is cut into ranges and a day heavier than a range."""
    rng = random.Random(seed)
    lines = []
    for i in range(400):
        k = 1 if i % 3 else rng.choice([2, 3, 4, 5, 99, None])
        day = 15 if i % 5 == 0 else rng.randint(-5, 60)
        lines.append((i, k, None if i % 41 == 0 else D(2000, 1, 1) + dt.timedelta(day)))
    df = spark.createDataFrame(lines, "id long, customer long, day date")
    dim = spark.createDataFrame(versions(rng, [1, 2, 3, 4, 5, 6], 40), DIM)
    got = as_of.as_of_lookup(df, dim, "customer", "k", "sk", "day", per=per)
    assert rows_of(got) == rows_of(dim_lookup(df, dim, "customer", "k", "sk", version="as_of", at="day"))


def test_as_of_pass_makes_no_more_rows_than_lines_and_versions(spark):
    """A key with 10,000 versions: the equi-join would make 2,000 x 10,000 rows."""
    first = F.lit("1980-01-01").cast("date")
    dim = spark.range(10000).select(
        F.lit(1).cast("long").alias("k"), F.col("id").alias("sk_id"), F.date_add(first, F.col("id").cast("int")).alias("effective_date"),
        F.date_add(first, F.col("id").cast("int") + 1).alias("expiration_date"), (F.col("id") == 9999).alias("current_flag"))
    df = spark.range(2000).select("id", F.lit(1).cast("long").alias("customer"), F.date_add(first, (F.col("id") * 5 + 3).cast("int")).alias("day"))
    for per in (100000, 100):
        events, _ = as_of.as_of_events(df, dim, "customer", "k", "day", per=per)
        assert events.count() <= 12000
        got = as_of.as_of_lookup(df, dim, "customer", "k", "sk", "day", per=per)
        assert got.filter(F.col("sk") != F.col("id") * 5 + 3).count() == 0 and got.filter("sk is null").count() == 0


def test_as_of_pass_cuts_a_hot_key(spark):
    df = spark.range(1000).select("id", F.lit(1).cast("long").alias("customer"), F.lit("2001-01-01").cast("date").alias("day"))
    dim = spark.createDataFrame([(1, 5, D(2000, 1, 1), OPEN, True)], DIM)
    events, _ = as_of.as_of_events(df, dim, "customer", "k", "day", per=100)
    sizes = [r["count"] for r in events.groupBy("_key", "_range").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200
    assert as_of.as_of_lookup(df, dim, "customer", "k", "sk", "day", per=100).filter("sk = 5").count() == 1000


# -- change log -------------------------------------------------------------------------------

LOG = SCHEMA + ", day date, seq int, _deleted boolean"


def by_days(spark, hist, log):
    """The log applied one day after the other by the snapshot merge."""
    state = {r.k: (r.a, r.b) for r in hist.filter("current_flag").collect()}
    columns = hist.columns
    for day in sorted({e[3] for e in log}):
        for k, a, b, _, _, gone in sorted((e for e in log if e[3] == day), key=lambda e: e[4]):
            if gone is False:
                state[k] = (a, b)
            else:
                state.pop(k, None)
        cur = spark.createDataFrame([(k, *v) for k, v in state.items()], SCHEMA)
        rows = [tuple(r) for r in scd2.scd2_merge(hist, cur, "k", TRACKED, day).select(*columns).collect()]
        hist = spark.createDataFrame(rows, hist.schema)
    return hist


@pytest.mark.parametrize("seed", range(2))
def test_log_equals_one_day_at_a_time(spark, seed):
    rng = random.Random(seed)
    rows = [(None if k == 0 else k, "a", None, k + 1, D(2024, 1, 1), OPEN, True) for k in range(8)]
    rows += [(k, "z", "z", 50 + k, D(2023, 1, 1), D(2024, 1, 1), False) for k in (3, 20)]
    log = [(rng.choice([None, *range(1, 12)]), rng.choice("ab"), rng.choice([None, "x"]), D(2024, 1, rng.randint(1, 6)), i,
            rng.choice([False, False, False, True, None])) for i in range(60)]
    hist = history(spark, rows)
    got = scd2_log.scd2_apply_log(hist, spark.createDataFrame(log, LOG), "k", TRACKED, "day", ["seq"])
    assert rows_of(got, *hist.columns) == rows_of(by_days(spark, hist, log))


def test_log_merges_neighbours_and_leaves_gaps(spark):
    hist = history(spark, [(1, "a", None, 1, D(2024, 1, 1), OPEN, True)])
    log = [(1, "a", None, D(2024, 1, 2), 1, False),      # as it was
           (1, "b", None, D(2024, 1, 3), 2, False), (1, "c", None, D(2024, 1, 3), 3, False),  # the last of a day
           (1, "c", None, D(2024, 1, 4), 4, False),      # equal neighbour
           (1, None, None, D(2024, 1, 6), 5, True), (1, None, None, D(2024, 1, 7), 6, True),  # a gap
           (1, "c", None, D(2024, 1, 9), 7, False), (2, "x", None, D(2024, 1, 5), 8, True)]
    got = scd2_log.scd2_apply_log(hist, spark.createDataFrame(log, LOG), "k", TRACKED, "day", ["seq"])
    assert rows_of(got, "k", "a", "sk_id", "effective_date", "expiration_date", "current_flag") == [
        (1, "a", 1, D(2024, 1, 1), D(2024, 1, 3), False), (1, "c", 2, D(2024, 1, 3), D(2024, 1, 6), False),
        (1, "c", 3, D(2024, 1, 9), OPEN, True)]
    none = scd2_log.scd2_apply_log(hist, spark.createDataFrame([], LOG), "k", TRACKED, "day", ["seq"])
    assert rows_of(none, *hist.columns) == rows_of(hist)


def test_log_refuses_events_before_the_open_version(spark):
    hist = history(spark, [(1, "a", None, 1, D(2024, 1, 5), OPEN, True)])
    log = spark.createDataFrame([(1, "b", None, D(2024, 1, 4), 1, False)], LOG)
    with pytest.raises(ValueError, match="1 events are older"):
        scd2_log.scd2_apply_log(hist, log, "k", TRACKED, "day", ["seq"])


# -- distinct values by counts -----------------------------------------------------------------

def test_support_loses_a_value_with_its_last_row(spark):
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    counts = support.support_counts(values(1, 1, 2, None, 3), "v")
    after = support.change_support(counts, values(1, 2, None), values(3, 4), "v")
    assert rows_of(after) == [(1, 1), (3, 2), (4, 1)]
    assert rows_of(support.supported_values(after, "v")) == [(1,), (3,), (4,)]
    assert rows_of(support.change_support(after, values(1), values(None), "v")) == [(3, 2), (4, 1), (None, 1)]
    with pytest.raises(Exception, match="support below zero: 7"):
        support.change_support(counts, values(7), values(), "v").collect()


# -- run-time filters -----------------------------------------------------------------------------

def stored_blocks(spark, tmp_path, n=1000):
    rows = spark.range(n).select("id", (F.col("id") * 2).alias("v"), F.floor(F.col("id") / 100).alias("block"))
    rows.repartition(2).write.partitionBy("block").parquet(f"{tmp_path}/s")
    spark.range(0, n, 3).select("id", (F.col("id") % 400).alias("changed_on")).write.parquet(f"{tmp_path}/k")
    return spark.read.parquet(f"{tmp_path}/s"), spark.read.parquet(f"{tmp_path}/k").filter("changed_on = 3").select("id")


def test_home_partitions_are_chosen_at_run_time(spark, tmp_path):
    stored, keys = stored_blocks(spark, tmp_path)
    found = home.rows_at_home(stored, keys, "id", "block", F.floor(F.col("id") / 100))
    assert "dynamicpruning" in plan_of(found)
    assert {r.id for r in found.collect()} == {r.id for r in keys.collect()}
    assert home.rows_at_home(stored, keys.limit(0), "id", "block", F.floor(F.col("id") / 100)).count() == 0


def test_home_search_by_a_bloom_filter(spark, tmp_path):
    stored, keys = stored_blocks(spark, tmp_path)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
                "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = home.rows_at_home(stored, keys, "id", "block")
        assert "might_contain" in plan_of(found)
        assert {r.id for r in found.collect()} == {r.id for r in keys.collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# -- repair of the fact ------------------------------------------------------------------------------

def test_repair_rewrites_only_months_whose_version_changed(spark):
    days = [D(2001, m, 10) for m in range(1, 13)]
    header = spark.createDataFrame([(i, i // 12, dt.datetime.combine(d, dt.time())) for i, d in enumerate(days * 3)],
                                   "salesorderid long, customerid long, orderdate timestamp_ntz")
    old = spark.createDataFrame([(0, 1, D(2001, 1, 1), D(2001, 6, 1), False), (0, 2, D(2001, 6, 1), OPEN, True),
                                 (1, 3, D(2001, 1, 1), OPEN, True)], DIM)
    new = spark.createDataFrame([(0, 1, D(2001, 1, 1), D(2001, 4, 1), False), (0, 2, D(2001, 4, 1), OPEN, True),
                                 (1, 3, D(2001, 1, 1), OPEN, True), (2, 4, D(2001, 11, 1), OPEN, True)], DIM)

    def fact(dim):
        out = as_of.as_of_lookup(header, dim, "customerid", "k", "customer_key", "orderdate")
        return out.select("salesorderid", "customer_key", F.col("orderdate").cast("date").alias("orderdate"),
                          F.trunc("orderdate", "month").alias("order_month"))
    months, rows = repair.repaired_months(fact(old), header, old, new, "customerid", "k", "customer_key")
    met = {r[0] for r in months.collect()}
    assert met == {D(2001, 4, 1), D(2001, 5, 1), D(2001, 11, 1), D(2001, 12, 1)}
    kept = fact(old).filter(~F.col("order_month").isin(list(met)))
    assert rows_of(kept.unionByName(rows)) == rows_of(fact(new))
    same, none = repair.repaired_months(fact(old), header, old, old, "customerid", "k", "customer_key")
    assert same.count() == 0 and none.count() == 0


# -- greatest values from footers ---------------------------------------------------------------------

def test_max_from_footers(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(100).select(F.col("id").alias("sk_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int"))
                            .alias("day"), (F.col("id") % 2).alias("part")).write.partitionBy("part").parquet(path)
    both = statistics.max_from_files(spark, path, "sk_id", "day")
    assert both.collect() == [(99, D(2024, 1, 7))]
    assert "PushedAggregation: [MAX(sk_id), MAX(day)]" in plan_of(both)
    by_part = statistics.max_from_files(spark, path, "sk_id", where=F.col("part") == 0)
    assert by_part.first()[0] == 98 and "PushedAggregation: [MAX(sk_id)]" in plan_of(by_part)
    scanned = statistics.max_from_files(spark, path, "sk_id", where=F.col("day") < "2024-01-03")
    assert scanned.first()[0] == 99 and "MAX(sk_id)" not in plan_of(scanned).split("PushedAggregation")[1][:40]
    # The caller's session plans as before.
    assert "PushedAggregation" not in plan_of(spark.read.parquet(path).agg(F.max("sk_id")))


def test_greatest_value_of_files_without_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(None,)], "x long").write.parquet(path)
    assert statistics.greatest(spark, path, "x") is None
    spark.createDataFrame([(4,), (7,)], "x long").write.mode("append").parquet(path)
    assert statistics.greatest(spark, path, "x") == 7


# -- changed schemas -------------------------------------------------------------------------------------

OLD = "k int, a string, n decimal(6,2), sk_id long, effective_date date, expiration_date date, current_flag boolean"
NEW = "k long, a string, n decimal(9,3), c string"


def test_merge_over_a_newer_schema(spark):
    from decimal import Decimal
    hist = spark.createDataFrame([(1, "a", Decimal("1.50"), 1, D(2024, 1, 1), OPEN, True),
                                  (2, "b", Decimal("2.00"), 2, D(2024, 1, 1), OPEN, True),
                                  (3, "c", None, 3, D(2023, 1, 1), D(2024, 1, 1), False)], OLD)
    cur = spark.createDataFrame([(1, "a", Decimal("1.5"), "new"), (2, "b", Decimal("2"), None), (4, "d", None, "x")], NEW)
    out = evolve.scd2_merge_evolved(hist, cur, "k", ["a", "n", "c"], "2024-02-01")
    # Wider types are no change; a filled new column is one.
    assert rows_of(out, "k", "c", "sk_id", "current_flag") == [
        (1, "new", 5, True), (1, None, 1, False), (2, None, 2, True), (3, None, 3, False), (4, "x", 4, True)]
    assert out.schema["n"].dataType.simpleString() == "decimal(9,3)" and out.schema["k"].dataType.simpleString() == "bigint"
    fill = evolve.scd2_merge_evolved(hist, cur, "k", ["a", "n", "c"], "2024-02-01", added="fill")
    assert rows_of(fill, "k", "c", "sk_id", "current_flag") == [
        (1, "new", 1, True), (2, None, 2, True), (3, None, 3, False), (4, "x", 4, True)]
    assert fill.columns == out.columns


@pytest.mark.parametrize("schema, message", [
    ("k int, a string, n decimal(6,1)", "'n' narrows from decimal\\(6,2\\) to decimal\\(6,1\\)"),
    ("k smallint, a string, n decimal(6,2)", "'k' narrows from int to smallint"),
    ("k int, a int, n decimal(6,2)", "'a' narrows from string to int"),
    ("k int, n decimal(6,2)", "lacks columns of the history: \\['a'\\]")])
def test_narrowing_is_an_error(spark, schema, message):
    with pytest.raises(ValueError, match=message):
        evolve.conform_history(spark.createDataFrame([], OLD), spark.createDataFrame([], schema))


def test_what_widens():
    from pyspark.sql import types as T
    yes = [(T.IntegerType(), T.LongType()), (T.ByteType(), T.DecimalType(3, 0)), (T.FloatType(), T.DoubleType()),
           (T.DateType(), T.TimestampNTZType()), (T.IntegerType(), T.DoubleType()), (T.DecimalType(5, 2), T.DecimalType(8, 4))]
    no = [(T.LongType(), T.IntegerType()), (T.LongType(), T.DoubleType()), (T.IntegerType(), T.DecimalType(9, 0)),
          (T.DoubleType(), T.FloatType()), (T.DecimalType(5, 2), T.DecimalType(6, 4)), (T.StringType(), T.LongType())]
    assert all(evolve.widens(a, b) for a, b in yes) and not any(evolve.widens(a, b) for a, b in no)
