import datetime as dt
import math

from pyspark.sql import functions as F

from basketry.functions import columns as C


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_half_day_recency(spark):
    df = spark.createDataFrame([(ts("2024-01-08 12:00:00"),)], "d timestamp")
    v = df.select(C.days_between(F.lit("2025-01-01").cast("timestamp"), "d").alias("x")).first()["x"]
    assert v == 358.5


def test_whole_days_floor_negative(spark):
    df = spark.createDataFrame([(ts("2024-01-02 12:00:00"), ts("2024-01-01 00:00:00"))], "a timestamp, b timestamp")
    r = df.select(C.whole_days_between("b", "a").alias("neg"), C.whole_days_between("a", "b").alias("pos")).first()
    assert (r["neg"], r["pos"]) == (-2, 1)


def test_safe_div(spark):
    df = spark.createDataFrame([(10.0, 0), (10.0, None), (10.0, 4)], "a double, b int")
    got = [r[0] for r in df.select(C.safe_div("a", "b")).collect()]
    assert got == [0.0, 0.0, 2.5]
    kept = [r[0] for r in df.select(C.safe_div("a", "b", zero=None)).collect()]
    assert kept == [None, None, 2.5]


def test_list_size_keeps_null(spark):
    df = spark.createDataFrame([("a,b,c",), (None,), ("x",)], "s string")
    assert [r[0] for r in df.select(C.list_size("s")).collect()] == [3, None, 1]


def test_distinct_join_sorted(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, v string")
    got = {r["k"]: r["j"] for r in df.groupBy("k").agg(C.distinct_join("v").alias("j")).collect()}
    assert got == {1: "a,b", 2: None}


def test_lgamma_accuracy(spark):
    zs = [0.01, 0.1, 0.5, 1.0, 2.5, 7.3, 31.0, 400.0, 1000.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [r[0] for r in df.select(C.lgamma("z")).collect()]
    for z, g in zip(zs, got):
        assert abs(g - math.lgamma(z)) < 3e-10 * max(1.0, abs(math.lgamma(z)))
