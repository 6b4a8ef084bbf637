"""Property test: the partition-scoped upsert equals a plain keyed merge
computed in memory, for random targets, sources, moved keys and removals."""

import uuid

from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.sources import publish
from starloom.sources.publish import read_upserted, upsert_partitions

SCHEMA = "k int, v string, p string"
_parts = st.sampled_from(["a", "b", "c"])
_rows = st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["x", "y", "z"]), _parts),
                 unique_by=lambda r: r[0], max_size=7)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=_rows, source=_rows, removed=st.lists(st.integers(0, 9), unique=True, max_size=3))
def test_scoped_upsert_equals_a_full_merge(spark, tmp_path_factory, target, source, removed):
    path = str(tmp_path_factory.mktemp("up") / uuid.uuid4().hex)
    upsert_partitions(spark, path, spark.createDataFrame(target, SCHEMA), "k", "p")
    upsert_partitions(spark, path, spark.createDataFrame(source, SCHEMA), "k", "p",
                      remove_keys=spark.createDataFrame([(k,) for k in removed], "k int"))
    gone = {k for k, _, _ in source} | set(removed)
    expected = sorted([r for r in target if r[0] not in gone] + list(source))
    got = sorted(map(tuple, read_upserted(spark, path, StructType.fromDDL(SCHEMA)).collect())) if target or source else []
    assert got == expected


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=_rows, source=_rows)
def test_key_derived_partitions_skip_the_home_search(spark, tmp_path_factory, target, source):
    """With the partition a function of the key, the shortcut gives the same
    table as the general upsert."""
    part = {k: "abc"[k % 3] for k in range(10)}
    target = [(k, v, part[k]) for k, v, _ in target]
    source = [(k, v, part[k]) for k, v, _ in source]
    path = str(tmp_path_factory.mktemp("fk") / uuid.uuid4().hex)
    upsert_partitions(spark, path, spark.createDataFrame(target, SCHEMA), "k", "p",
                      partition_follows_key=True)
    upsert_partitions(spark, path, spark.createDataFrame(source, SCHEMA), "k", "p",
                      partition_follows_key=True)
    gone = {k for k, _, _ in source}
    expected = sorted([r for r in target if r[0] not in gone] + source)
    got = sorted(map(tuple, read_upserted(spark, path, StructType.fromDDL(SCHEMA)).collect())) if target or source else []
    assert got == expected


def test_derived_columns_and_rows_without_a_key(spark, tmp_path):
    """Derived columns are made where rows are written; a row without a key replaces
    none and is replaced by none; a key's old rows go from every partition."""
    path, schema = str(tmp_path / "d"), "k int, v int, p string, twice int"

    def put(rows, **options):
        df = spark.createDataFrame([(*r, 2 * r[1]) for r in rows], schema)
        return upsert_partitions(spark, path, df, "k", "p", derived={"twice": F.col("v") * 2}, **options)
    put([(1, 1, "a"), (1, 2, "b"), (2, 3, "a"), (None, 4, "a"), (3, 5, None), (4, 6, "c")])
    written = put([(1, 7, "c"), (1, 8, "c"), (None, 9, "a")], removes_all=True,
                  remove_keys=spark.createDataFrame([(1,), (3,)], "k int"),
                  parts=spark.createDataFrame([("c",), ("a",)], "p string"))
    assert set(written) == {"a", "b", "c", None}
    got = {tuple(r) for r in read_upserted(spark, path, StructType.fromDDL(schema)).select("k", "v", "p", "twice").collect()}
    assert got == {(1, 7, "c", 14), (1, 8, "c", 16), (2, 3, "a", 6), (None, 4, "a", 8), (None, 9, "a", 18), (4, 6, "c", 12)}


def test_a_first_load_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    """The newest row of each key is taken in the ranges that the files are written from."""
    written = []
    monkeypatch.setattr(publish, "overwrite_partitions", lambda df, path, *a, **k: (
        written.append((df, k["placed"])), df.write.partitionBy(*a).parquet(path), {})[-1])
    rows = spark.createDataFrame([(i % 50, i, i % 50 // 10) for i in range(200)], "k int, ts int, block int")
    upsert_partitions(spark, str(tmp_path / "f"), rows, ["k"], "block", order_cols=["ts"], partition_follows_key=True)
    (df, placed), = written
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert placed and plan.count("Exchange ") == 1
    assert sorted(r["ts"] for r in df.collect()) == list(range(150, 200))
