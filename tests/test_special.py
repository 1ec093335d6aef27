"""Special functions and p-values against closed forms and numeric integration."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.functions import special
from basketry.operators import stats


def values(spark, rows, schema, column):
    return [r["v"] for r in spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"k int, {schema}")
            .select("k", column.alias("v")).orderBy("k").collect()]


def test_log_gamma_and_derivatives(spark):
    points = [1e-3, 0.01, 0.3, 1.0, 2.0, 7.5, 40.0, 1234.5, 1e5, 3e7]
    got = values(spark, [(z,) for z in points], "z double", special.log_gamma("z"))
    for z, v in zip(points, got):
        assert v == pytest.approx(math.lgamma(z), rel=1e-14, abs=2e-13)
    for z, d, t in zip(points[:8], values(spark, [(z,) for z in points], "z double", special.digamma("z")),
                       values(spark, [(z,) for z in points], "z double", special.trigamma("z"))):
        h = 1e-3 * z
        slope = lambda f: (8 * (f(z + h) - f(z - h)) - (f(z + 2 * h) - f(z - 2 * h))) / (12 * h)
        assert d == pytest.approx(slope(math.lgamma), rel=1e-7, abs=1e-8)
        # recurrence psi'(z) - psi'(z + 1) = 1 / z^2
        up = values(spark, [(z + 1,)], "z double", special.trigamma("z"))[0]
        assert t - up == pytest.approx(1 / z ** 2, rel=1e-9)
    assert values(spark, [(1.0,)], "z double", special.digamma("z"))[0] == pytest.approx(-0.5772156649015329, abs=1e-13)
    assert values(spark, [(1.0,)], "z double", special.trigamma("z"))[0] == pytest.approx(math.pi ** 2 / 6, abs=1e-13)
    ratio = values(spark, [(a, b) for a in (0.5, 3.0, 5e4, 1e8) for b in (0.5, 2.0)], "a double, b double",
                   special.log_gamma_ratio("a", "b"))
    exact = [math.lgamma(1.0) - math.lgamma(0.5), math.log(0.5 * 1.5), math.lgamma(3.5) - math.lgamma(3), math.log(12), None,
             math.log(5e4 * (5e4 + 1)), None, math.log(1e8 * (1e8 + 1))]
    assert all(e is None or g == pytest.approx(e, rel=1e-13) for g, e in zip(ratio, exact))


def test_normal_and_chi_square_tails(spark):
    z = [0.0, 1e-6, 0.3, 1.0, 1.7, 1.959963984540054, -3.0, 5.0, 9.0, 30.0]
    for x, v in zip(z, values(spark, [(x,) for x in z], "z double", special.normal_two_sided("z"))):
        assert v == pytest.approx(math.erfc(abs(x) / math.sqrt(2)), rel=1e-11, abs=1e-300)
    for dof in (2, 4, 10, 400):
        xs = [0.0, 0.1, 1.0, dof / 2, float(dof), dof + 3.0, 2.5 * dof]
        got = values(spark, [(x, float(dof)) for x in xs], "x double, d double", special.chi_square_tail("x", "d"))
        for x, v in zip(xs, got):
            logs = [k * math.log(x / 2) - math.lgamma(k + 1) - x / 2 for k in range(dof // 2)] if x else [0.0]
            assert v == pytest.approx(math.fsum(map(math.exp, logs)), rel=1e-10)
    assert values(spark, [(3.841458820694124, 1.0)], "x double, d double", special.chi_square_tail("x", "d"))[0] == \
        pytest.approx(0.05, abs=1e-12)


def test_student_t(spark):
    t = [0.0, 0.01, 0.5, 1.0, 2.0, -4.0, 12.0]
    call = lambda dof: values(spark, [(x, dof) for x in t], "t double, d double", special.t_two_sided("t", "d"))
    for x, v in zip(t, call(1.0)):
        assert v == pytest.approx(1 - 2 / math.pi * math.atan(abs(x)), abs=1e-12)
    for x, v in zip(t, call(2.0)):
        assert v == pytest.approx(1 - abs(x) / math.sqrt(2 + x * x), abs=1e-12)
    for dof in (7.5, 1234.5, 98765.0):
        high = min(math.pi / 2, 40 / math.sqrt(dof))

        def area(a):
            u = np.linspace(a, max(a, high), 200_001)
            f = np.exp((dof - 1) * np.log(np.maximum(np.cos(u), 1e-300)))
            return (u[1] - u[0]) / 3 * (f[0] + f[-1] + 4 * f[1:-1:2].sum() + 2 * f[2:-1:2].sum())

        for x, v in zip(t, call(dof)):
            assert v == pytest.approx(area(math.atan(abs(x) / math.sqrt(dof))) / area(0.0), abs=2e-12)
    # with many degrees of freedom t is normal
    for x in (1e-4, 0.01, 1.96):
        assert values(spark, [(x, 1e9)], "t double, d double", special.t_two_sided("t", "d"))[0] == pytest.approx(
            math.erfc(x / math.sqrt(2)), abs=1e-9)
        # both forms agree where one takes over from the other
        a, b = values(spark, [(x, 1e6 - 1e-3), (x, 1e6 + 1e-3)], "t double, d double", special.t_two_sided("t", "d"))
        assert a == pytest.approx(b, abs=1e-11)


def test_beta_part(spark):
    pairs = [(x, a, b) for x in (0.0, 0.05, 0.5, 0.93, 1.0) for a, b in ((1.0, 1.0), (2.0, 3.0), (1.0, 7.0), (6.0, 1.0))]
    got = values(spark, pairs, "x double, a double, b double", special.beta_part("x", "a", "b"))
    for (x, a, b), v in zip(pairs, got):
        # integer parameters: a binomial tail
        n = int(a + b - 1)
        assert v == pytest.approx(sum(math.comb(n, j) * x ** j * (1 - x) ** (n - j) for j in range(int(a), n + 1)), abs=1e-13)


def test_p_values_where_nothing_can_be_tested(spark):
    one = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", None)], "g string, x double")
    r = stats.welch_t(one, "x", "g", "a", "b").first()
    assert r["t"] is None and r["p_value"] is None
    same = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, x double")
    assert stats.welch_t(same, "x", "g", "a", "b").first()["p_value"] is None
    r = stats.ab_two_proportion(same, "g", F.col("x") > 0, "a", "b").first()
    assert r["z"] is None and r["p_value"] is None
    flat = stats.chi_square(spark.createDataFrame([("u", "v"), ("u", "w")], "a string, b string"), "a", "b").first()
    assert flat["dof"] == 0 and flat["p_value"] is None
    none = stats.chi_square(spark.createDataFrame([], "a string, b string"), "a", "b").first()
    assert none["p_value"] is None
    strong = spark.createDataFrame([("a", float(k % 7)) for k in range(80)] + [("b", 3.0 + k % 7) for k in range(80)], "g string, x double")
    assert stats.welch_t(strong, "x", "g", "a", "b").first()["p_value"] < 1e-9
