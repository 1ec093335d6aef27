"""Causal effect, survival, return rules, calibration and holdout against
planted values and brute force."""

import datetime as dt
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import calibration, clv, inference, rules, survival


def confounded(n=4000, effect=2.0, seed=3):
    """Gold customers spend more and are treated more often."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        tier, age = rnd.choice(("gold", "silver", None)), rnd.uniform(20, 60)
        p = 1 / (1 + math.exp(-({"gold": 1.2, "silver": -0.5, None: -1.0}[tier] + 0.02 * (age - 40))))
        t = rnd.random() < p
        y = {"gold": 10.0, "silver": 4.0, None: 1.0}[tier] + 0.1 * age + effect * t + rnd.gauss(0, 1)
        rows.append((str(i), tier, age, t, y))
    return rows


SCHEMA = "customer_id string, tier string, age double, t boolean, y double"


def test_effect_under_confounding(spark):
    df = spark.createDataFrame(confounded(), SCHEMA).repartition(5)
    r = inference.causal_effect(df, "customer_id", "y", F.col("t"), ["tier"], ["age"], replicates=100).first()
    assert r["n"] == 4000 and abs(r["effect"] - 2.0) < 4 * r["std_error"] < 0.2
    assert r["naive_difference"] > 3.5                      # what one gets without adjusting
    assert r["low"] < r["effect"] < r["high"] and r["p_value"] < 1e-9
    assert abs((r["high"] - r["low"]) / (2 * 1.96 * r["std_error"]) - 1) < 0.35
    # nothing planted, nothing found
    none = spark.createDataFrame(confounded(effect=0.0, seed=8), SCHEMA)
    r = inference.causal_effect(none, "customer_id", "y", F.col("t"), ["tier"], ["age"], replicates=50).first()
    assert abs(r["effect"]) < 4 * r["std_error"] and r["p_value"] > 1e-4
    # right with a useless propensity model (no covariate in it but the outcome's) and null rows left out
    extra = df.unionByName(spark.createDataFrame([("x", "gold", 1.0, None, 5.0), ("z", "gold", 1.0, True, None)], SCHEMA))
    assert inference.influence(extra, "customer_id", "y", F.col("t"), ["tier"], ["age"]).count() == 4000


def test_effect_without_two_groups(spark):
    one = spark.createDataFrame([("a", "gold", 1.0, True, 1.0), ("b", None, 2.0, True, 3.0)], SCHEMA)
    r = inference.causal_effect(one, "customer_id", "y", F.col("t"), ["tier"]).first()
    assert (r["n"], r["n_treated"], r["effect"]) == (2, 2, None)
    empty = inference.causal_effect(one.where("false"), "customer_id", "y", F.col("t"), ["tier"]).first()
    assert (empty["n"], empty["n_treated"], empty["p_value"]) == (0, 0, None)


def test_bootstrap_weights(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("i"), (F.col("id") % 10).cast("double").alias("v"))
    a = {r["replicate"]: r["v"] for r in inference.replicate_means(df.repartition(3), "i", {"v": F.col("v")}, 40).collect()}
    b = {r["replicate"]: r["v"] for r in inference.replicate_means(df.repartition(7), "i", {"v": F.col("v")}, 40).collect()}
    assert a.keys() == b.keys() == set(range(1, 41)) and all(abs(a[k] - b[k]) < 1e-12 for k in a)
    assert abs(np.mean(list(a.values())) - 4.5) < 0.05
    assert abs(np.std(list(a.values())) - np.sqrt(8.25 / 2000)) < 0.025
    w = df.select(inference.poisson_weight(F.col("i"), F.lit(1)).alias("w")).collect()
    seen = Counter(r["w"] for r in w)
    for k in range(4):
        assert abs(seen[k] / 2000 - math.exp(-1) / math.factorial(k)) < 0.04


def day(month, d=1):
    return dt.datetime(2020 + (month - 1) // 12, (month - 1) % 12 + 1, d)


def test_survival_knows_censoring(spark):
    rnd = random.Random(2)
    rows, lives = [], []
    for c in range(400):
        first = rnd.randint(1, 20)
        last = min(24, first + rnd.choice((0, 0, 1, 2, 5, 9, 30)))
        rows += [(str(c), day(m, rnd.randint(1, 28))) for m in {first, last}]
        lives.append((2020 + (first - 1) // 12, last - first, int(24 - last >= 3)))
    rows += [("end", day(24)), (None, day(3)), ("none", None)]
    lives.append((2021, 0, 0))
    orders = spark.createDataFrame(rows, "customer_id string, order_date timestamp").repartition(3)
    got = {(int(r["cohort"]), r["months"]): r for r in survival.retention_survival(orders).collect()}
    assert set(got) == {(g, m) for g, m, _ in lives}
    for g in (2020, 2021):
        s, v = 1.0, 0.0
        for m in sorted({x for y, x, _ in lives if y == g}):
            n = sum(1 for y, x, _ in lives if y == g and x >= m)
            d = sum(e for y, x, e in lives if y == g and x == m)
            c = sum(1 - e for y, x, e in lives if y == g and x == m)
            s, v = s * (1 - d / n), v + (d / (n * (n - d)) if n > d else 0.0)
            r = got[g, m]
            assert (r["at_risk"], r["lost"], r["censored"]) == (n, d, c) and abs(r["survival"] - s) < 1e-8
            assert r["std_error"] is None or abs(r["std_error"] - s * math.sqrt(v)) < 1e-8
    # a cohort whose whole life is the last months has no false drop
    young = spark.createDataFrame([("a", day(23)), ("b", day(24)), ("c", day(24)), ("d", day(22))], "customer_id string, order_date timestamp")
    assert {r["survival"] for r in survival.retention_survival(young).collect()} == {1.0}
    assert survival.retention_survival(young.where("false")).count() == 0


def test_log_rank(spark):
    rnd = random.Random(5)
    data = [("ab"[k % 2], min(20, int(rnd.expovariate((0.1, 0.2)[k % 2]))), int(rnd.random() < 0.8)) for k in range(300)]
    df = spark.createDataFrame(data + [("c", 3, 1), (None, 2, 0)], "g string, months int, lost int")
    r = survival.log_rank(df, "g", "a", "b").first()
    e = v = 0.0
    for m in {x for _, x, _ in data}:
        na, nb = (sum(1 for g, x, _ in data if g == h and x >= m) for h in "ab")
        d = sum(lost for _, x, lost in data if x == m)
        n = na + nb
        e += d * na / n
        v += d * na * nb * (n - d) / (n * n * (n - 1)) if n > 1 else 0.0
    lost = sum(x for g, _, x in data if g == "a")
    assert r["lost_a"] == lost and abs(r["expected_a"] - e) < 1e-5 and abs(r["chi_square"] - (lost - e) ** 2 / v) < 1e-4
    assert r["p_value"] == pytest.approx(math.erfc(math.sqrt((lost - e) ** 2 / v / 2)), abs=1e-8)
    same = survival.log_rank(df.where("lost = 0"), "g", "a", "b").first()
    assert same["chi_square"] is None and same["p_value"] is None


def test_return_rules_against_brute_force(spark):
    rnd = random.Random(9)
    data = []
    for i in range(300):
        own = sorted(set(rnd.choices("abcdefgh", weights=range(8, 0, -1), k=rnd.randint(0, 6))))
        data.append((str(i), int(rnd.random() < (0.6 if {"a", "c"} <= set(own) else 0.2)), own))
    df = spark.createDataFrame(data, "order_id string, returned int, features array<string>").repartition(3)
    for support, size in ((0.05, 3), (0.2, 2), (0.3, 1)):
        back = sum(r for _, r, _ in data)
        every, returned = Counter(), Counter()
        for _, r, own in data:
            for k in range(1, size + 1):
                for s in itertools.combinations(own, k):
                    every[s] += 1
                    returned[s] += r
        want = {" & ".join(s): (len(s), every[s], returned[s], round(returned[s] / every[s], 6),
                                round(returned[s] / every[s] / (back / 300), 6)) for s in every if returned[s] >= math.ceil(support * back)}
        got = {r["features"]: (r["size"], r["orders"], r["returned_orders"], r["return_rate"], r["lift"])
               for r in rules.return_rules(df, support, size).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)
    best = max(want, key=lambda k: want[k][4])
    assert best in ("a", "c")
    assert rules.return_rules(df.where("returned = 0")).count() == 0


def pool(points):
    """Adjacent violators by hand: (score, rate, weight) -> fitted rate."""
    blocks = []
    for s, y, w in sorted(points):
        blocks.append([y * w, w, [s]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            y2, w2, s2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + y2, blocks[-1][1] + w2, blocks[-1][2] + s2]
    return {s: y / w for y, w, ss in blocks for s in ss}


def test_calibration(spark):
    rnd = random.Random(4)
    data = []
    for _ in range(3000):
        s = rnd.randint(0, 60) / 60
        data.append((s, int(rnd.random() < 0.2 + 0.5 * s * s)))
    df = spark.createDataFrame([(str(k), *r) for k, r in enumerate(data)] + [("x", None, 1), ("y", 0.5, None)],
                               "customer_id string, score double, churn_next_30d int").repartition(3)
    per = Counter(round(s, 4) for s, _ in data)
    hits = Counter(round(s, 4) for s, y in data if y)
    want = pool([(s, hits[s] / n, n) for s, n in per.items()])
    model = calibration.fit_calibration(df)
    rows = calibration.calibrated(model, df).collect()
    assert len(rows) == 3002
    for r in rows:
        assert r["calibrated"] is None if r["score"] is None else r["calibrated"] == pytest.approx(want[round(r["score"], 4)], abs=1e-12)
    table = {r["bin"]: r for r in calibration.churn_calibration(df).collect()}
    assert table[-1]["customers"] == 3000
    # calibrated scores agree with the rate in every bin, raw ones do not
    assert table[-1]["brier_calibrated"] < table[-1]["brier"] - 0.02
    assert abs(table[-1]["mean_calibrated"] - table[-1]["observed"]) < 1e-8
    assert max(abs(r["mean_calibrated"] - r["observed"]) for r in table.values()) < 0.05
    assert max(abs(r["mean_score"] - r["observed"]) for r in table.values()) > 0.15
    assert table[9]["customers"] == sum(s >= 0.9 for s, _ in data)


def test_holdout(spark):
    d0 = dt.datetime(2024, 1, 1)
    at = lambda k, h=0: d0 + dt.timedelta(days=k, hours=h)
    rows = [("a", at(0)), ("a", at(0, 5)), ("a", at(30)), ("a", at(95)), ("a", at(100)), ("b", at(10)), ("c", at(95)), ("d", at(90)),
            ("d", at(91)), (None, at(3)), ("e", None)]
    orders = spark.createDataFrame(rows, "customer_id string, order_date timestamp")
    p = {"r": 0.8, "alpha": 40.0, "a": 0.9, "b": 2.5}
    got = {r["frequency_class"]: r for r in clv.clv_holdout(orders, 10, **p).collect()}
    # up to day 90: a twice (then 95, 100), b once, d once (then 91); c is new in the days held out
    assert set(got) == {0, 1} and got[0]["customers"] == 2 and got[1]["customers"] == 1
    assert got[1]["actual"] == 2.0 and got[0]["actual"] == 0.5
    s = spark.createDataFrame([("a", 1, 30, 91, 0.0), ("b", 0, 0, 81, 0.0), ("d", 0, 0, 1, 0.0)],
                              "customer_id string, frequency long, recency int, T int, monetary_value double")
    e = {r["customer_id"]: r["expected_purchases"] for r in clv.expected_purchases(s, 10.0, **p).collect()}
    assert got[1]["expected"] == pytest.approx(e["a"], abs=1e-6)
    assert got[0]["mean_error"] == pytest.approx((e["b"] + e["d"] - 1) / 2, abs=1e-6)
    assert got[0]["mean_abs_error"] == pytest.approx((abs(e["b"]) + abs(e["d"] - 1)) / 2, abs=1e-6)
    assert clv.clv_holdout(orders.where("false"), 10, **p).count() == 0
