import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators.quantiles import column_quantiles, grouped_quantiles

QS = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("ranges", [2, 16, 200])
def test_grouped_quantiles_exact(spark, ranges):
    rnd = random.Random(1)
    rows = ([("a", rnd.gauss(0, 1)) for _ in range(5000)] + [("b", float(rnd.randint(0, 5))) for _ in range(801)]
            + [("c", None), ("c", 2.0)])
    got = grouped_quantiles(spark.createDataFrame(rows, "g string, v double"), QS, ranges=ranges)
    for g in "abc":
        vals = np.array([v for gg, v in rows if gg == g and v is not None])
        assert np.allclose(got[g], np.quantile(vals, QS), rtol=0, atol=1e-12)


def test_column_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, None), (3.0, None), (10.0, 7), (None, 9)], "x double, y int")
    got = column_quantiles(df, ["x", "y"], [0.5])
    assert got == {"x": [2.5], "y": [7.0]}


def test_weights_count_values(spark):
    rows = [("a", 1.0, 3), ("a", 5.0, 1), ("a", 9.0, 2), ("b", 2.0, 0), ("b", 7.0, 5), ("c", None, 4)]
    got = grouped_quantiles(spark.createDataFrame(rows, "g string, v double, w long"), [0.25, 0.5, 0.75])
    assert np.allclose(got["a"], np.quantile([1, 1, 1, 5, 9, 9], [0.25, 0.5, 0.75]))
    assert got["b"] == [7.0, 7.0, 7.0] and "c" not in got


def test_range_of_is_a_binary_search(spark):
    import bisect
    from basketry.operators.quantiles import range_of, sketched_cuts
    rows = [(k, float(v), sorted(set(cuts))) for k, (v, cuts) in enumerate(
        (v, [float(c) for c in range(0, n * 3, 3)]) for n in (0, 1, 2, 3, 7, 8, 64, 100) for v in (-1, 0, 1, 3, 20, 21, 22, 500))]
    df = spark.createDataFrame(rows, "k int, v double, cuts array<double>")
    got = {r["k"]: r["b"] for r in df.select("k", range_of(F.col("v"), F.col("cuts")).alias("b")).collect()}
    assert got == {k: bisect.bisect_left(cuts, v) for k, v, cuts in rows}
    plan = df.select(range_of(F.col("v"), F.col("cuts")))._jdf.queryExecution().executedPlan().toString()
    assert "filter(" not in plan
    cuts = spark.range(10_001).select(F.col("id").cast("double").alias("v")).agg(sketched_cuts("v", 10).alias("c")).first()["c"]
    assert len(cuts) == 9 and all(abs(c - 1000 * (k + 1)) < 300 for k, c in enumerate(cuts))
    assert spark.range(0).select(F.col("id").cast("double").alias("v")).agg(sketched_cuts("v", 4).alias("c")).first()["c"] is None
