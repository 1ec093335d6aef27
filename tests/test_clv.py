import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from basketry.operators import clv


def _orders(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(c, d, Decimal(v)) for c, d, v in rows],
                                 "customer_id string, order_date timestamp, order_amount decimal(18,2)")


def test_two_orders_one_day(spark):
    d = dt.datetime(2024, 1, 1)
    o = _orders(spark, [("a", d, 5), ("a", d + dt.timedelta(hours=3), 7), ("b", d + dt.timedelta(days=4), 1)])
    rows = {r["customer_id"]: r for r in clv.purchase_summary(o).collect()}
    assert (rows["a"]["frequency"], rows["a"]["recency"], rows["a"]["monetary_value"]) == (0, 0, 0.0)
    assert rows["a"]["T"] == 5 and rows["b"]["T"] == 1


def test_monetary_is_mean_of_repeat_days(spark):
    d = dt.datetime(2024, 1, 1)
    o = _orders(spark, [("a", d, 100), ("a", d + dt.timedelta(days=2), 10), ("a", d + dt.timedelta(days=2), 20),
                        ("a", d + dt.timedelta(days=5), 60)])
    r = clv.purchase_summary(o).first()
    assert (r["frequency"], r["recency"], r["T"], r["monetary_value"]) == (2, 5, 6, 45.0)


def _simulate_bgnbd(n, r, alpha, a, b, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lam = rng.gamma(r, 1.0 / alpha)
        p = rng.beta(a, b)
        T = float(rng.integers(60, 120))
        t, x, tx = 0.0, 0, 0.0
        while True:
            t += rng.exponential(1.0 / lam)
            if t > T:
                break
            x, tx = x + 1, t
            if rng.random() < p:
                break
        rows.append((str(i), x, tx, T))
    return rows


def _bgnbd(rows, r, alpha, a, b):
    """Mean log-likelihood by the published formula."""
    total = 0.0
    for _, x, t, T in rows:
        a12 = (math.lgamma(r + x) - math.lgamma(r) + r * math.log(alpha) + math.lgamma(a + b)
               + math.lgamma(b + x) - math.lgamma(b) - math.lgamma(a + b + x))
        a3 = -(r + x) * math.log(alpha + T)
        a4 = math.log(a) - math.log(b + max(x, 1) - 1) - (r + x) * math.log(alpha + t)
        m = max(a3, a4)
        total += a12 + m + math.log(math.exp(a3 - m) + (math.exp(a4 - m) if x > 0 else 0.0))
    return total / len(rows)


def _gamma_gamma(rows, p, q, v):
    return sum(math.lgamma(p * x + q) - math.lgamma(p * x) - math.lgamma(q) + q * math.log(v) + (p * x - 1) * math.log(m)
               + p * x * math.log(x) - (p * x + q) * math.log(x * m + v) for x, m in rows) / len(rows)


def _check_derivatives(f, point, got):
    value, first, second = got
    k, h = len(point), 1e-4
    at = lambda *moves: f(*(p + h * sum(s for j, s in moves if j == i) for i, p in enumerate(point)))
    assert abs(value - f(*point)) < 1e-10
    for i in range(k):
        assert abs(first[i] - (at((i, 1)) - at((i, -1))) / (2 * h)) < 1e-6
        for j in range(k):
            want = (at((i, 1), (j, 1)) - at((i, 1), (j, -1)) - at((i, -1), (j, 1)) + at((i, -1), (j, -1))) / (4 * h * h)
            assert abs(second[i, j] - want) < 2e-5 * max(1.0, abs(want)), (i, j)


def test_derivatives_of_both_likelihoods(spark):
    rows = _simulate_bgnbd(300, 0.8, 4.0, 0.9, 2.5) + [("x", 0, 0.0, 0.0), ("y", 60, 59.0, 60.0), ("z", 1, 2.0, 100.0)]
    df = spark.createDataFrame([(x, t, T, 1.0) for _, x, t, T in rows], "x long, rec double, age double, n double")
    for point in ((0.7, 3.0, 1.1, 2.0), (2.5, 0.6, 0.2, 0.4)):
        _check_derivatives(lambda *p: _bgnbd(rows, *p), point, clv.bgnbd_derivatives(df, *point))
        ll = clv.bgnbd_log_likelihood(F.col("x"), F.col("rec"), F.col("age"), clv.bgnbd_point(*point))
        assert abs(df.agg(F.avg(ll)).first()[0] - _bgnbd(rows, *point)) < 1e-8
    # weights count rows, and time may be scaled
    twice = df.withColumn("n", F.lit(2.0)).unionByName(df)
    assert abs(clv.bgnbd_derivatives(twice, 0.7, 3.0, 1.1, 2.0)[0] - _bgnbd(rows, 0.7, 3.0, 1.1, 2.0)) < 1e-10
    scaled = [(c, x, t / 10, T / 10) for c, x, t, T in rows]
    assert abs(clv.bgnbd_derivatives(df, 0.7, 3.0, 1.1, 2.0, scale=0.1)[0] - _bgnbd(scaled, 0.7, 3.0, 1.1, 2.0)) < 1e-10
    rng = np.random.default_rng(3)
    money = [(int(rng.integers(1, 9)), float(rng.gamma(5.0, 3.0))) for _ in range(200)]
    df = spark.createDataFrame([(x, m, 1.0) for x, m in money], "x long, m double, n double")
    for point in ((6.0, 4.0, 15.0), (0.8, 1.3, 2.0)):
        _check_derivatives(lambda *p: _gamma_gamma(money, *p), point, clv.gamma_gamma_derivatives(df, *point))


def test_ridge_and_errors(spark):
    rows = _simulate_bgnbd(800, 0.8, 4.0, 0.9, 2.5, seed=9)
    summary = spark.createDataFrame([(c, x, int(round(t)), int(T), 0.0) for c, x, t, T in rows],
                                    "customer_id string, frequency long, recency int, T int, monetary_value double")
    free, held = clv.fit_bgnbd(summary, ridge=0.0).first(), clv.fit_bgnbd(summary, ridge=0.1).first()
    assert free["converged"] and held["converged"] and max(free["rounds"], held["rounds"]) <= 15
    # without a ridge the errors are those of the inverse information, taken here by differences
    whole = [(c, x, float(round(t)), float(int(T))) for c, x, t, T in rows]
    names, h = ("r", "alpha", "a", "b"), 1e-3
    at = [free["params"][k] for k in names]
    f = lambda *moves: _bgnbd(whole, *(p * (1 + h * sum(s for j, s in moves if j == i)) for i, p in enumerate(at)))
    information = np.array([[-(f((i, 1), (j, 1)) - f((i, 1), (j, -1)) - f((i, -1), (j, 1)) + f((i, -1), (j, -1)))
                             / (4 * h * h * at[i] * at[j]) for j in range(4)] for i in range(4)]) * len(rows)
    want = np.sqrt(np.diag(np.linalg.inv(information)))
    for k, w in zip(names, want):
        assert abs(free["std_error"][k] - w) < 0.02 * w
        assert held["std_error"][k] < free["std_error"][k]


def test_bgnbd_recovers_parameters(spark):
    rows = _simulate_bgnbd(3000, 0.8, 4.0, 0.9, 2.5, seed=5)
    summary = spark.createDataFrame([(c, x, int(round(t)), int(T), 0.0) for c, x, t, T in rows],
                                    "customer_id string, frequency long, recency int, T int, monetary_value double")
    fit = clv.fit_bgnbd(summary, ridge=0.0)
    assert fit.first()["converged"] and fit.first()["gradient"] < 1e-4
    p = clv.parameters(fit, "bgnbd")
    assert abs(p["r"] - 0.8) / 0.8 < 0.25 and abs(p["alpha"] - 4.0) / 4.0 < 0.3
    assert abs(p["a"] / (p["a"] + p["b"]) - 0.9 / 3.4) < 0.08


def test_gamma_gamma_recovers_parameters(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(2500):
        nu = rng.gamma(4.0, 1.0 / 15.0)
        x = int(rng.integers(1, 8))
        m = float(np.mean(rng.gamma(6.0, 1.0 / nu, size=x)))
        rows.append((str(i), x, 0, 0, m))
    summary = spark.createDataFrame(rows, "customer_id string, frequency long, recency int, T int, monetary_value double")
    fit = clv.fit_gamma_gamma(summary, ridge=0.0)
    p = clv.parameters(fit, "gamma_gamma")
    assert fit.first()["converged"] and fit.first()["gradient"] < 1e-4
    assert abs(p["p"] - 6) / 6 < 0.25 and abs(p["q"] - 4) / 4 < 0.3 and abs(p["v"] - 15) / 15 < 0.35


def test_scores_and_parameter_store(spark, tmp_path):
    s = spark.createDataFrame([("a", 0, 0, 30, 0.0), ("b", 3, 20, 30, 50.0)],
                              "customer_id string, frequency long, recency int, T int, monetary_value double")
    pa = {r["customer_id"]: r["p_alive"] for r in clv.p_alive(s, 0.8, 4.0, 0.9, 2.5).collect()}
    want = 1 / (1 + 0.9 / (2.5 + 3 - 1) * ((4 + 30) / (4 + 20)) ** (0.8 + 3))
    assert pa["a"] == 1.0 and abs(pa["b"] - want) < 1e-6
    es = {r["customer_id"]: r["expected_spend"] for r in clv.expected_spend(s, 6.0, 4.0, 15.0).collect()}
    assert abs(es["b"] - 6 * (15 + 3 * 50) / (6 * 3 + 3)) < 1e-6
    ep = clv.expected_purchases(s, 30.0, 0.8, 4.0, 0.9, 2.5).collect()
    assert all(r["expected_purchases"] > 0 for r in ep)
    params = clv._params(s, "bgnbd", {"r": 0.8, "alpha": 4.0, "a": 0.9, "b": 2.5}, 1.0, 0.0, 1.0, True, 3, 2, 0.0)
    path = str(tmp_path / "params")
    clv.save_parameters(params, path)
    assert clv.parameters(clv.read_parameters(spark, path), "bgnbd")["alpha"] == 4.0


def _exact_purchases(x, t, T, h, r, alpha, a, b):
    """The published formula, its series summed term by term until nothing changes."""
    z = h / (alpha + T + h)
    term = total = 1.0
    k = 0
    while abs(term) > 1e-18 * abs(total) or k < 50:
        term *= (r + x + k) * (b + x + k) / ((a + b + x - 1 + k) * (k + 1)) * z
        total += term
        k += 1
    first = (a + b + x - 1) / (a - 1) * (1 - ((alpha + T) / (alpha + T + h)) ** (r + x) * total)
    return first / (1 + (a / (b + x - 1) * ((alpha + T) / (alpha + t)) ** (r + x) if x else 0.0))


def test_expected_purchases_of_frequent_buyers(spark):
    rows = [(99, 98, 100), (400, 429, 430), (900, 959, 960), (0, 0, 3), (1, 2, 700), (30, 30, 31)]
    s = spark.createDataFrame([(str(k), x, t, T, 1.0) for k, (x, t, T) in enumerate(rows)],
                              "customer_id string, frequency long, recency int, T int, monetary_value double")
    for p in ((0.8, 40.0, 0.9, 2.5), (0.3, 5.0, 1.7, 1.1), (2.0, 100.0, 3.5, 0.6)):
        got = {int(r["customer_id"]): r["expected_purchases"] for r in clv.expected_purchases(s, 365.0, *p).collect()}
        for k, (x, t, T) in enumerate(rows):
            want = _exact_purchases(x, t, T, 365.0, *p)
            assert abs(got[k] - want) < 1e-5 * max(1.0, abs(want)), (p, rows[k], got[k], want)


def test_both_models_in_one_call(spark):
    s = spark.createDataFrame([("a", 0, 0, 30, 0.0), ("b", 0, 0, 20, 0.0)],
                              "customer_id string, frequency long, recency int, T int, monetary_value double")
    rows = {r["model"]: r for r in clv.fit_value_models(s).collect()}
    assert not rows["gamma_gamma"]["converged"] and rows["gamma_gamma"]["params"] == {}
    assert rows["bgnbd"]["customers"] == 2 and rows["bgnbd"]["params"]["r"] > 0


def test_a_round_is_one_aggregate(spark, monkeypatch):
    from basketry.operators import fit
    plans = []
    agg = type(spark.range(1)).agg
    monkeypatch.setattr(type(spark.range(1)), "agg", lambda self, *c: plans.append(agg(self, *c)) or plans[-1])
    df = spark.createDataFrame([(1, 2.0, 3.0, 1.0)], "x long, rec double, age double, n double")
    clv.bgnbd_derivatives(df, 0.7, 3.0, 1.1, 2.0)
    assert len(plans) == 1 and fit.STEP_LENGTHS[0] == 1.0
    text = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "lambdafunction" not in text
