from pyspark.sql import functions as F

from basketry.operators.scan import running_sums


def test_running_sums_exact(spark):
    df = spark.range(1, 2001).select(F.col("id").alias("s"), (F.col("id") % 3).alias("v"))
    for ranges in (2, 16, 300):
        got = {r["s"]: r["v_before"] for r in running_sums(df, "s", ["v"], ranges=ranges).collect()}
        acc = 0
        for s in range(1, 2001):
            assert got[s] == acc
            acc += s % 3


def test_running_sums_empty(spark):
    assert running_sums(spark.createDataFrame([], "s double, v long"), "s", ["v"]).count() == 0


def test_running_sums_within_groups(spark):
    rows = [(g, float(s), s % 4) for g, n in (("a", 500), ("b", 3), (None, 40)) for s in range(n)]
    df = spark.createDataFrame(rows, "g string, s double, v long").repartition(3)
    for ranges in (2, 16):
        got = {(r["g"], r["s"]): r["v_before"] for r in running_sums(df, "s", ["v"], ranges=ranges, group="g").collect()}
        assert got == {(g, s): sum(k % 4 for k in range(int(s))) for g, s, _ in rows}
