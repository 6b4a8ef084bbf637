"""Scalar functions (2.7) on literal rows."""

import hashlib

from pyspark.sql import functions as F

from starloom.functions import scalar


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def test_full_name_skips_nulls_and_all_null_is_empty(spark):
    df = spark.createDataFrame([("A", None, "C"), (None, None, None)], "f string, m string, l string")
    got = [r[0] for r in df.select(scalar.full_name("f", "m", "l")).collect()]
    assert got == ["A C", ""]


def test_plain_fingerprint_collides_as_the_reference_does(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "a"), ("a", None)], "x string, y string")
    fp = [r[0] for r in df.select(scalar.row_fingerprint(["x", "y"])).collect()]
    assert fp[0] == fp[1] == md5("abc")
    assert fp[2] == fp[3] == md5("a")


def test_safe_fingerprint_separates_the_collisions(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "a"), ("a", None)], "x string, y string")
    fp = [r[0] for r in df.select(scalar.row_fingerprint_safe(["x", "y"])).collect()]
    assert len(set(fp)) == 4
    assert fp[0] == md5("2:ab1:c")
    assert fp[2] == md5("~1:a")


def test_empty_fingerprint_is_md5_of_one(spark):
    df = spark.range(1)
    assert df.select(scalar.row_fingerprint([])).first()[0] == md5("1")
    assert df.select(scalar.row_fingerprint_safe([])).first()[0] == md5("1")


def test_surrogate_hash_joins_with_dash_and_replaces_nulls(spark):
    df = spark.createDataFrame([(1, 2), (3, None)], "a long, b long")
    got = [r[0] for r in df.select(scalar.surrogate_hash(["a", "b"])).collect()]
    assert got[0] == md5("1-2")
    assert got[1] == md5("3-_surrogate_key_null_")


def test_decode_order_status(spark):
    df = spark.createDataFrame([(c,) for c in [None, 0, 1, 2, 3, 4, 5, 6, 7]], "s int")
    got = [r[0] for r in df.select(scalar.decode_order_status("s")).collect()]
    assert got == ["no_status", "no_status", "in_process", "approved", "backordered",
                   "rejected", "shipped", "cancelled", "no_status"]


def test_revenue_is_decimal_18_2_and_exact(spark):
    df = spark.createDataFrame([("12.34", 3)], "p string, q int").select(
        F.col("p").cast("decimal(12,2)").alias("p"), "q")
    out = df.select(scalar.revenue("p", "q").alias("r"))
    assert out.schema["r"].dataType.simpleString() == "decimal(18,2)"
    assert str(out.first()["r"]) == "37.02"


def test_format_and_cast_date(spark):
    df = spark.sql("select timestamp_ntz'2001-06-30 13:45:00' as ts")
    row = df.select(scalar.format_date("ts").alias("s"), scalar.to_date("ts").alias("d")).first()
    assert row["s"] == "2001-06-30"
    assert str(row["d"]) == "2001-06-30"
