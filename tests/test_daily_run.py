"""Publishing, landing with watermarks and the two-batch daily run."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import SF_SMALL
from starloom.operators import scd2
from starloom.plans import daily_run, dimensions, facts
from starloom.sources import publish
from starloom.sources.fixtures import FixtureSource


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def test_overwrite_observes_what_it_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    assert publish.overwrite(spark.range(7), path) == {"rows": 7}
    assert publish.overwrite(spark.range(3), path, last=F.max("id")) == {"rows": 3, "last": 2}
    assert spark.read.parquet(path).count() == 3
    assert publish.overwrite(spark.range(0), path, last=F.max("id")) == {"rows": 0, "last": None}


def test_partitions_are_replaced_by_a_plan_that_reads_them(spark, tmp_path):
    """Q4: reading a table and writing its next state from that plan."""
    path = str(tmp_path / "t")
    publish.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, "p")
    now = spark.read.parquet(path)
    assert publish.overwrite_partitions(now.filter("p = 'a'").select((F.col("x") + 10).alias("x"), "p"), path, "p") == {"rows": 1}
    assert sorted((r.x, r.p) for r in spark.read.parquet(path).collect()) == [(2, "b"), (11, "a")]


def test_existence_checks(spark, tmp_path):
    from starloom.sources import tables
    path = str(tmp_path / "p")
    assert not tables.path_has_data(spark, path)
    spark.createDataFrame([], "x int").write.parquet(path)
    assert not tables.path_has_data(spark, path)          # empty dataset: first load
    spark.createDataFrame([(1,)], "x int").write.mode("append").parquet(path)
    assert tables.path_has_data(spark, path)


def test_append_and_truncate_load(spark, tmp_path):
    path = str(tmp_path / "w")
    publish.append(spark.createDataFrame([(1,)], "x int"), path)
    publish.append(spark.createDataFrame([(2,)], "x int"), path)
    assert spark.read.parquet(path).count() == 2
    publish.truncate_load(spark.createDataFrame([(3,)], "x int"), path)
    assert [r.x for r in spark.read.parquet(path).collect()] == [3]


def test_upsert_partitions_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "f")
    base = spark.createDataFrame([(1, "a", "p1"), (2, "b", "p1"), (3, "c", "p2"), (4, "d", "p3")],
                                 "k int, v string, p string")
    assert sorted(publish.upsert_partitions(spark, path, base, "k", "p")) == ["p1", "p2", "p3"]
    p3_files = {r[0] for r in spark.read.parquet(path).filter("p = 'p3'")
                .select(F.input_file_name()).collect()}
    # key 1 changes, key 3 moves from p2 to p1, key 5 is new in p2
    src = spark.createDataFrame([(1, "a2", "p1"), (3, "c2", "p1"), (5, "e", "p2")],
                                "k int, v string, p string")
    assert sorted(publish.upsert_partitions(spark, path, src, "k", "p")) == ["p1", "p2"]
    got = sorted(map(tuple, publish.read_upserted(spark, path, base.schema).collect()))
    assert got == [(1, "a2", "p1"), (2, "b", "p1"), (3, "c2", "p1"), (4, "d", "p3"), (5, "e", "p2")]
    assert {r[0] for r in spark.read.parquet(path).filter("p = 'p3'")
            .select(F.input_file_name()).collect()} == p3_files
    # moving the only row of p3 away leaves p3 empty; removing key 5 empties p2
    publish.upsert_partitions(spark, path, spark.createDataFrame([(4, "d", "p1")],
                              "k int, v string, p string"), "k", "p",
                              remove_keys=spark.createDataFrame([(5,)], "k int"))
    got = sorted(map(tuple, publish.read_upserted(spark, path, base.schema).collect()))
    assert got == [(1, "a2", "p1"), (2, "b", "p1"), (3, "c2", "p1"), (4, "d", "p1")]


def test_number_like_partitions_keep_their_text(spark, tmp_path):
    path, schema = str(tmp_path / "f"), "k int, v string, p string"
    publish.upsert_partitions(spark, path, spark.createDataFrame(
        [(1, "a", "01"), (2, "b", "02"), (3, "c", "02")], schema), "k", "p")
    publish.upsert_partitions(spark, path, spark.createDataFrame([(3, "c", "01")], schema), "k", "p")
    got = sorted(map(tuple, publish.read_upserted(spark, path, StructType.fromDDL(schema)).collect()))
    assert got == [(1, "a", "01"), (2, "b", "02"), (3, "c", "01")]


def test_files_of_a_partition_follow_its_size(spark, tmp_path):
    path = str(tmp_path / "f")
    rows = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 20).cast("string").alias("p"))
    publish.upsert_partitions(spark, path, rows.repartition(16), "k", "p")
    files = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 40                                     # not one from each task


def test_truncate_load_keeps_a_tables_partitioning(spark):
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string").write.mode("overwrite") \
        .partitionBy("p").saveAsTable("part_probe")
    publish.truncate_load(spark.createDataFrame([("c", 3)], "p string, k int"), "part_probe")
    assert [(r.k, r.p) for r in spark.table("part_probe").collect()] == [(3, "c")]
    assert [c.name for c in spark.catalog.listColumns("part_probe") if c.isPartition] == ["p"]


def test_only_a_missing_path_reads_as_no_table(spark, tmp_path):
    from starloom.sources import tables
    assert not tables.path_has_data(spark, str(tmp_path / "none"))
    with pytest.raises(Exception, match="no_such_format"):
        tables.path_has_data(spark, str(tmp_path), "no_such_format")


# -- landing -----------------------------------------------------------------------

SRC = "k int, v string, modifieddate timestamp_ntz, _deleted boolean"


def test_landing_ties_and_deletes(spark):
    """Q6/Q7: rows tied at the watermark are applied; deletes remove keys;
    changed rows replace, never duplicate."""
    target = spark.createDataFrame([(1, "a", ts("2001-01-02")), (2, "b", ts("2001-01-01"))],
                                   "k int, v string, modifieddate timestamp_ntz")
    source = spark.createDataFrame([
        (1, "a", ts("2001-01-02"), False), (3, "c", ts("2001-01-02"), False),   # tie at watermark
        (2, "b", ts("2001-01-01"), False), (1, "a2", ts("2001-01-03"), False),
        (4, "d", ts("2001-01-03"), True)], SRC)
    out = facts.landing_incremental(source, target, ["k"])
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "a2"), (2, "b"), (3, "c")]
    strict = facts.landing_incremental(source, target, ["k"], strict=True)
    assert sorted((r.k, r.v) for r in strict.collect()) == [(1, "a2"), (2, "b")]


def test_fact_increment_filter_on_empty_target_is_a_full_load(spark):
    fact = spark.createDataFrame([(dt.date(2001, 1, 1),)], "orderdate date")
    assert facts.fact_increment_filter(fact, fact.limit(0)).count() == 1


# -- daily run ------------------------------------------------------------------------

class ShiftedSource(FixtureSource):
    """Second day of the source: some customers deleted, names changed, new
    order lines past the first day's watermark."""

    def _person_person(self):
        df = super()._person_person()
        return df.withColumn("lastname", F.when(F.col("businessentityid") % 5 == 0,
                                                F.concat("lastname", F.lit("_x")))
                             .otherwise(F.col("lastname")))

    def _sales_customer(self):
        df = super()._sales_customer()
        return df.withColumn("_deleted", F.when(F.col("customerid") % 11 == 0, F.lit(True))
                             .otherwise(F.col("_deleted")))

    # Late changes to old orders, after the first day's watermark: lines of
    # orders % 7 = 1 are deleted, lines of orders % 11 = 2 get quantity 99.
    def _sales_salesorderdetail(self):
        df = super()._sales_salesorderdetail()
        late = F.lit("2002-01-01 00:00:00").cast("timestamp_ntz")
        live = F.col("_deleted") == F.lit(False)
        df = df.withColumns({"_del": (F.col("salesorderid") % 7 == 1) & live,
                             "_chg": (F.col("salesorderid") % 11 == 2) & live
                             & (F.col("salesorderid") % 7 != 1)})
        return (df.withColumns({
                    "orderqty": F.when(F.col("_chg"), F.lit(99)).otherwise(F.col("orderqty")),
                    "_deleted": F.when(F.col("_del"), F.lit(True)).otherwise(F.col("_deleted")),
                    "modifieddate": F.when(F.col("_del") | F.col("_chg"), late)
                                     .otherwise(F.col("modifieddate"))})
                  .drop("_del", "_chg"))


@pytest.mark.slow
def test_two_day_run_then_revenue(spark, tmp_path):
    root = str(tmp_path / "wh")
    day1 = FixtureSource(spark, SF_SMALL)
    spark.conf.set("starloom.landing.orderBlockSize", "1000")
    try:
        r1 = daily_run.run_daily(spark, day1, root, "2024-01-01", run_id="20240101")
    finally:
        spark.conf.unset("starloom.landing.orderBlockSize")
    landed = spark.read.parquet(f"{root}/landing_salesorderdetail")
    assert landed.filter("_placeholder").count() == 0
    blocks = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet") \
        .select(F.floor(F.col("l_orderkey") / 1000)).distinct().count()
    assert landed.select("order_block").distinct().count() == blocks > 1
    assert landed.filter("_deleted = false").count() == 5227  # live lines, one per key
    assert landed.filter("_deleted is distinct from false").count() > 0  # deletes kept as versions
    # the watermark is the max timestamp of the rows written
    assert r1.watermarks["salesorderdetail"] == landed.agg(F.max("modifieddate")).first()[0]
    fact1 = daily_run.read_fact(spark, root, with_month=True)
    assert fact1.count() == 5227          # distinct sales keys at sf0.001
    # what day 1 left behind (the path is rewritten in place by day 2)
    kept = fact1.filter("salesorderid % 7 != 1").count()
    files1: dict = {}
    for r in fact1.select("order_month", F.input_file_name().alias("f")).distinct().collect():
        files1.setdefault(r.order_month, set()).add(r.f)
    # row counts observed while writing
    assert r1.rows["stg_dim_customer"] == r1.rows["dim_customer"] == 130
    r2 = daily_run.run_daily(spark, ShiftedSource(spark, SF_SMALL), root, "2024-01-02",
                             run_id="20240102")
    assert set(r2.published) == set(r1.published)
    assert r2.watermarks["salesorderdetail"] == dt.datetime(2002, 1, 1)     # the late changes
    staged = spark.read.parquet(f"{root}/stg_dim_customer").schema
    dim = dimensions.read_dimension(spark, f"{root}/dim_customer", staged)
    assert dim.schema["current_flag"].dataType.simpleString() == "boolean"
    # open rows by bucket, closed ones by the day that they ended
    opened = dimensions.read_dimension(spark, f"{root}/dim_customer", staged, open_only=True)
    assert opened.filter("not current_flag").count() == 0
    closed = spark.read.parquet(f"{root}/dim_customer").filter("key_bucket = -1")
    assert [str(r[0]) for r in closed.select("expiration_date").distinct().collect()] == ["2024-01-02"]
    assert dim.count() == opened.count() + closed.count()
    assert dim.filter("current_flag").groupBy("customerid").count().filter("count > 1").count() == 0
    assert dim.filter("not current_flag and expiration_date = date'2024-01-02'").count() > 0
    fact2 = daily_run.read_fact(spark, root, with_month=True)
    assert fact2.count() == fact2.select("sales_key").distinct().count()
    # late deletes left the fact, late corrections reached it, nothing else changed
    assert fact2.filter("salesorderid % 7 = 1").count() == 0
    changed = fact2.filter("salesorderid % 11 = 2")
    assert changed.count() > 0 and changed.filter("orderqty != 99").count() == 0
    assert changed.filter("revenue != cast(unitprice * 99 as decimal(18,2))").count() == 0
    assert fact2.count() == kept
    # months were rewritten only where orders changed
    assert r2.rewritten_partitions
    files2: dict = {}
    for r in fact2.select("order_month", F.input_file_name().alias("f")).distinct().collect():
        files2.setdefault(r.order_month, set()).add(r.f)
    rewritten = set(r2.rewritten_partitions)
    assert all(files2[m] == files1[m] for m in files1 if m not in rewritten)
    assert all(files2.get(m) != files1[m] for m in rewritten if m in files1)
    dims = {n: dimensions.read_dimension(spark, f"{root}/{n}", spark.read.parquet(f"{root}/stg_{n}").schema)
            for n in ("dim_product", "dim_address")}
    rev = daily_run.revenue_by_dimension(fact2, dims["dim_product"], dims["dim_address"])
    total = fact2.agg(F.sum("revenue")).first()[0]
    assert rev.agg(F.sum("revenue")).first()[0] == total
    # a third run with the same input (and a lookback window re-reading the
    # last day of changes) changes nothing
    n2, files = fact2.count(), set(spark.read.parquet(f"{root}/dim_customer").inputFiles())
    before = sorted(map(tuple, dim.collect()), key=str)
    spark.conf.set("starloom.landing.lookbackSeconds", str(24 * 3600))
    try:
        daily_run.run_daily(spark, ShiftedSource(spark, SF_SMALL), root, "2024-01-02",
                            run_id="20240103")
    finally:
        spark.conf.unset("starloom.landing.lookbackSeconds")
    assert daily_run.read_fact(spark, root).count() == n2
    dim3 = dimensions.read_dimension(spark, f"{root}/dim_customer", staged)
    assert sorted(map(tuple, dim3.collect()), key=str) == before
    assert set(spark.read.parquet(f"{root}/dim_customer").inputFiles()) == files     # not even written


@pytest.mark.slow
def test_command_line_run_over_dataset_sources(spark, tmp_path, capsys):
    """The operational tables stored as parquet datasets under one root, the
    daily load run through the command line."""
    import json
    from starloom import cli
    from starloom.sources.fixtures import SOURCE_NAMES
    src_root, target = tmp_path / "oltp", tmp_path / "wh"
    fixtures = FixtureSource(spark, SF_SMALL)
    for name in SOURCE_NAMES:
        fixtures(name).write.parquet(str(src_root / name))
    assert cli.main(["--source-root", str(src_root), "--target", str(target),
                     "--load-date", "1995-01-01", "--run-id", "r1", "--fact-version", "as_of"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["run_id"] == "r1" and out["rows"]["dim_customer"] == 130
    fact = daily_run.read_fact(spark, str(target))
    assert fact.count() == 5227
    # as of the order date: every order is on/after the 1995-01-01 load, so
    # every line with a live customer finds the (only) version
    assert fact.filter("customer_key is not null").count() > 0


def test_catalog_sources_and_a_mirror_sink(spark, tmp_path):
    """Source tables in a catalog database (table scans by name) and every
    snapshot-published table mirrored to a second sink."""
    from starloom.sources.fixtures import SOURCE_NAMES
    from starloom.sources.tables import table_reader
    from starloom.plans import staging
    spark.sql("CREATE DATABASE IF NOT EXISTS oltp_probe")
    fixtures = FixtureSource(spark, SF_SMALL)
    for name in SOURCE_NAMES:
        fixtures(name).write.mode("overwrite").saveAsTable(f"oltp_probe.{name}")
    read = table_reader(spark, database="oltp_probe")
    a = staging.stg_dim_address(read)
    b = staging.stg_dim_address(fixtures)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    mirrored = {}

    def mirror(name, df):
        path = str(tmp_path / "mirror" / name)
        publish.truncate_load(df, path)
        mirrored[name] = path

    result = daily_run.run_daily(spark, read, str(tmp_path / "wh"), "2024-01-01", run_id="m1",
                                 mirror=mirror)
    assert set(mirrored) == set(result.published)
    assert spark.read.parquet(mirrored["sales_fact"]).count() == daily_run.read_fact(spark, str(tmp_path / "wh")).count()
    assert spark.read.parquet(mirrored["dim_customer"]).count() == result.rows["dim_customer"]


def test_stored_dimension_over_several_runs(spark, tmp_path):
    """Each run equals the plain merge; a day is run twice with other rows; a bucket
    loses its last key; closed history is left where it is."""
    path, spec = str(tmp_path / "dim"), scd2.DimensionSpec("d", "stg", "k", ("v",))
    first = spark.createDataFrame([(i, "a") for i in range(12)] + [(None, "n")], "k int, v string")
    history = scd2.scd2_initial(first, "k", "2024-01-01")
    dimensions.store_dimension(history, path, "k", 8)
    history = spark.createDataFrame(history.collect(), history.schema)
    for day, rows in (("2024-02-01", [(1, "b"), (2, "a"), (None, "n")]), ("2024-02-01", [(2, "c"), (40, "x")]),
                      ("2024-02-01", [(2, "c"), (40, "x")]), ("2024-03-01", []), ("2024-04-01", [(1, "z")])):
        staged = spark.createDataFrame(rows, "k int, v string")
        files = {f for f in spark.read.parquet(path).inputFiles() if "key_bucket=-1" in f and day not in f}
        dimensions.merge_stored_dimension(spark, path, spec, staged, day, 8)
        history = scd2.scd2_merge(history, staged, "k", ["v"], day)
        history = spark.createDataFrame(history.collect(), history.schema)
        got = dimensions.read_dimension(spark, path, staged.schema)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, history.select(*got.columns).collect()), key=str)
        assert files <= set(spark.read.parquet(path).inputFiles())
        opened = dimensions.read_dimension(spark, path, staged.schema, open_only=True)
        assert opened.count() == len(rows)
