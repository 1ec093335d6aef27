"""Lifetime value V-01 .. V-06 and X-05 .. X-07.

The purchase history is reduced to day grain per customer in two partial
aggregations (customer x day, then customer), with no window.  The model
fits sum their likelihood in Spark over the history, written once since every
fit round reads it: BG/NBD over distinct (frequency, recency, T) with a count,
Gamma-Gamma over the buyers as they are (amounts hardly repeat).
BG/NBD: Fader, Hardie & Lee (2005).  Gamma-Gamma: Fader & Hardie (2013).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import lgamma
from basketry.functions.special import digamma_text, log_gamma_text, trigamma_text
from basketry.operators.fit import Derivatives, maximise, mean_derivatives
from basketry.operators.quantiles import column_quantiles
from basketry.session import materialise


def purchase_summary(orders: DataFrame, value: str = "order_amount", end=None) -> DataFrame:
    """V-01: per customer, at day grain: frequency = purchase days - 1,
    recency = last - first day, T = end - first day (end defaults to the
    last order day + 1), monetary_value = mean of the repeat days' totals
    (0 without a repeat day)."""
    day = F.to_date("order_date")
    daily = (orders.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
             .groupBy("customer_id", day.alias("day"))
             .agg(F.sum(F.col(value).cast("decimal(18,2)")).alias("v")))
    per = daily.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_days"), F.min("day").alias("_first"), F.max("day").alias("_last"),
        F.sum("v").alias("_total"), F.min_by("v", "day").alias("_first_v"))
    if end is None:
        # a scalar subquery: no job runs while the plan is built
        end_date = F.date_add(orders.agg(F.max(F.to_date("order_date"))).scalar(), 1)
    else:
        end_date = F.to_date(F.lit(end))
    freq = (F.col("_days") - 1).cast("bigint")
    repeat_total = F.coalesce(F.col("_total") - F.col("_first_v"), F.lit(0)).cast("double")
    return per.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        freq.alias("frequency"),
        F.datediff("_last", "_first").alias("recency"),
        F.datediff(end_date, "_first").alias("T"),
        F.when(freq > 0, repeat_total / freq.cast("double")).otherwise(F.lit(0.0)).alias("monetary_value"))


def monetary_cap(summary: DataFrame, q: float = 0.99) -> float | None:
    """The ``q`` quantile of monetary value (exact, distributed)."""
    return column_quantiles(summary, ["monetary_value"], [q])["monetary_value"][0]


def clv_fit_input(summary: DataFrame, cap_quantile: float = 0.99) -> DataFrame:
    """V-02: repeat buyers with positive value; monetary value capped at its
    ``cap_quantile`` quantile (over those buyers)."""
    kept = materialise(summary.where((F.col("monetary_value") > 0) & (F.col("frequency") > 0)), "repeat-buyers")
    cap = monetary_cap(kept, cap_quantile)
    if cap is None:
        return kept
    return kept.withColumn("monetary_value", F.least(F.col("monetary_value"), F.lit(cap)))


# --- fits -------------------------------------------------------------------------

def _number(v) -> F.Column:
    return v if isinstance(v, F.Column) else F.lit(float(v))


def bgnbd_log_likelihood(x: F.Column, t: F.Column, T: F.Column, p: dict) -> F.Column:
    """Per-customer BG/NBD log-likelihood at the point ``p`` (r, alpha, a, b and
    the part ``c`` that no customer changes)."""
    r, alpha, a, b, c = (_number(p[k]) for k in ("r", "alpha", "a", "b", "c"))
    xd = x.cast("double")
    a12 = lgamma(r + xd) + lgamma(b + xd) - lgamma(a + b + xd) + c
    a3 = -(r + xd) * F.log(alpha + T)
    a4 = F.log(a) - F.log(b + F.greatest(xd, F.lit(1.0)) - 1) - (r + xd) * F.log(alpha + t)
    m = F.greatest(a3, a4)
    both = F.exp(a3 - m) + F.when(xd > 0, F.exp(a4 - m)).otherwise(F.lit(0.0))
    return a12 + F.log(both) + m


def bgnbd_point(r: float, alpha: float, a: float, b: float) -> dict:
    c = -math.lgamma(r) + r * math.log(alpha) + math.lgamma(a + b) - math.lgamma(b)
    return {"r": r, "alpha": alpha, "a": a, "b": b, "c": c}


def bgnbd_likelihood(summary: DataFrame, r: float, alpha: float, a: float, b: float) -> DataFrame:
    """Sum of the BG/NBD log-likelihood at given parameters, and the customers."""
    ll = bgnbd_log_likelihood(F.col("frequency"), F.col("recency").cast("double"), F.col("T").cast("double"),
                              bgnbd_point(r, alpha, a, b))
    return summary.agg(F.round(F.sum(ll), 4).alias("log_likelihood"), F.count(F.lit(1)).alias("customers"))


def bgnbd_derivatives(data: DataFrame, r: float, alpha: float, a: float, b: float, scale: float = 1.0) -> Derivatives:
    """Mean log-likelihood over (x, rec, age, n) and its first and second
    derivatives by (r, alpha, a, b), in one job.  Times are multiplied by ``scale``."""
    d = lambda v: f"({float(v)!r}D)"
    base = data.selectExpr(
        "n", "cast(x AS double) AS x", "CASE WHEN x > 0 THEN 1D ELSE 0D END AS back", f"x + {d(r)} AS rx",
        f"greatest(x, 1D) + {d(b - 1)} AS bx", f"rec * {d(scale)} + {d(alpha)} AS u", f"age * {d(scale)} + {d(alpha)} AS w",
        f"x + {d(b)} AS xb", f"x + {d(a + b)} AS xab")
    # the two ways to be silent since the last purchase: still alive, or gone
    logs = base.selectExpr("*", "-rx * ln(w) AS alive", f"{d(math.log(a))} - ln(bx) - rx * ln(u) AS gone",
                           "ln(u) - ln(w) AS dr", "-rx * (1 / w - 1 / u) AS da")
    odds = logs.selectExpr("*", "CASE WHEN back > 0 THEN greatest(alive, gone) ELSE alive END AS top").selectExpr(
        "*", "exp(alive - top) AS ea", "back * exp(gone - top) AS eg")
    terms = odds.selectExpr(
        "n", "rx", "u", "w", "dr", "da", "1 / bx AS db", "ea / (ea + eg) AS p", "eg / (ea + eg) AS q", "top + ln(ea + eg) AS mix",
        f"{log_gamma_text('rx')} AS g_rx", f"{log_gamma_text('xb')} AS g_b", f"{log_gamma_text('xab')} AS g_ab",
        f"{digamma_text('rx')} AS d_rx", f"{digamma_text('xb')} AS d_b", f"{digamma_text('xab')} AS d_ab",
        f"{trigamma_text('rx')} AS t_rx", f"{trigamma_text('xb')} AS t_b", f"{trigamma_text('xab')} AS t_ab")
    ab, tab = _digamma(a + b), _trigamma(a + b)
    fixed = r * math.log(alpha) - math.lgamma(r) + math.lgamma(a + b) - math.lgamma(b)
    first = [f"d_rx + {d(math.log(alpha) - _digamma(r))} - p * ln(w) - q * ln(u)",
             f"{d(r / alpha)} - rx * (p / w + q / u)",
             f"{d(ab)} - d_ab + q / {d(a)}",
             f"d_b - d_ab + {d(ab - _digamma(b))} - q * db"]
    # the mixture of the two adds p q times the product of the differences (alive minus gone) by each parameter
    gap = ["dr", "da", d(-1 / a), "db"]
    second = {(i, j): f"p * q * {gap[i]} * {gap[j]}" for i in range(4) for j in range(i, 4)}
    for at, own in {(0, 0): f"t_rx - {d(_trigamma(r))}", (0, 1): f"{d(1 / alpha)} - p / w - q / u",
                    (1, 1): f"{d(-r / alpha ** 2)} + rx * (p / (w * w) + q / (u * u))",
                    (2, 2): f"{d(tab)} - t_ab - q / {d(a * a)}", (2, 3): f"{d(tab)} - t_ab",
                    (3, 3): f"{d(tab - _trigamma(b))} - t_ab + t_b + q * db * db"}.items():
        second[at] = f"{own} + {second[at]}"
    return mean_derivatives(terms, f"g_rx + g_b - g_ab + {d(fixed)} + mix", first, second)


def _digamma(z: float) -> float:
    """For the part of a derivative that no customer changes (the shift is long
    enough for double precision)."""
    w = z + 30
    tail = 1 / (12 * w ** 2) - 1 / (120 * w ** 4) + 1 / (252 * w ** 6) - 1 / (240 * w ** 8)
    return math.log(w) - 0.5 / w - tail - math.fsum(1 / (z + k) for k in range(30))


def _trigamma(z: float) -> float:
    w = z + 30
    tail = 1 / (6 * w ** 3) - 1 / (30 * w ** 5) + 1 / (42 * w ** 7) - 1 / (30 * w ** 9)
    return 1 / w + 0.5 / w ** 2 + tail + math.fsum(1 / (z + k) ** 2 for k in range(30))


def fit_bgnbd(summary: DataFrame, ridge: float = 1.0, max_rounds: int = 60) -> DataFrame:
    """V-03: BG/NBD by penalised maximum likelihood: minimise
    -mean ln L + ridge * sum(theta^2) over (r, alpha, a, b) with time scaled
    so the largest T is 10 (the scale is stored; alpha is reported in days).
    One row: model, params, scale, ridge, neg_log_likelihood, converged,
    rounds (jobs), customers, gradient (largest absolute slope at the end),
    std_error (per parameter)."""
    # (column names are case-insensitive: recency -> rec, T -> age)
    data = materialise(summary.groupBy(
        F.col("frequency").alias("x"), F.col("recency").cast("double").alias("rec"),
        F.col("T").cast("double").alias("age")).agg(F.count(F.lit(1)).cast("double").alias("n")), "history")
    stats = data.agg(F.max("age").alias("mt"), F.sum("n").alias("n")).first()
    if not stats["n"]:
        return _params(summary, "bgnbd", {}, 1.0, ridge, math.nan, False, 0, 0, math.nan)
    scale = 10.0 / stats["mt"] if stats["mt"] else 1.0
    fit = maximise(lambda theta: bgnbd_derivatives(data, *theta.tolist(), scale=scale), 4, ridge, stats["n"], max_rounds)
    unit = dict(zip(("r", "alpha", "a", "b"), (1.0, scale, 1.0, 1.0)))
    return _fitted(summary, "bgnbd", fit, unit, scale, ridge, stats["n"])


def _fitted(summary, model, fit, unit, scale, ridge, n) -> DataFrame:
    """Parameters and errors in the units of the data."""
    params = {k: v / u for (k, u), v in zip(unit.items(), fit.params)}
    errors = {k: v / u for (k, u), v in zip(unit.items(), fit.errors)}
    return _params(summary, model, params, scale, ridge, fit.value, fit.converged, fit.rounds, n, fit.slope, errors)


def gamma_gamma_log_likelihood(x: F.Column, m: F.Column, p: dict) -> F.Column:
    """Per-customer Gamma-Gamma log-likelihood at the point ``p`` (p, q, v, c)."""
    q, v = _number(p["q"]), _number(p["v"])
    xd = x.cast("double")
    px = _number(p["p"]) * xd
    return (lgamma(px + q) - lgamma(px) + _number(p["c"]) + (px - 1) * F.log(m)
            + px * F.log(xd) - (px + q) * F.log(xd * m + v))


def gamma_gamma_point(p: float, q: float, v: float) -> dict:
    return {"p": p, "q": q, "v": v, "c": -math.lgamma(q) + q * math.log(v)}


def _spenders(summary: DataFrame) -> DataFrame:
    return summary.where((F.col("frequency") > 0) & (F.col("monetary_value") > 0)).select(
        F.col("frequency").alias("x"), F.col("monetary_value").cast("double").alias("m"), F.lit(1.0).alias("n"))


def gamma_gamma_likelihood(summary: DataFrame, p: float, q: float, v: float) -> DataFrame:
    """Sum of the Gamma-Gamma log-likelihood at given parameters over repeat
    buyers with positive value, and their number."""
    ll = gamma_gamma_log_likelihood(F.col("x"), F.col("m"), gamma_gamma_point(p, q, v))
    return _spenders(summary).agg(F.round(F.sum(ll), 4).alias("log_likelihood"), F.count(F.lit(1)).alias("customers"))


def gamma_gamma_derivatives(data: DataFrame, p: float, q: float, v: float, scale: float = 1.0) -> Derivatives:
    """Mean log-likelihood over (x, m, n) and its first and second derivatives
    by (p, q, v), in one job.  Amounts are multiplied by ``scale``."""
    d = lambda v: f"({float(v)!r}D)"
    base = data.selectExpr("n", "cast(x AS double) AS x", f"m * {d(scale)} AS m", f"x * {d(p)} AS px", f"x * {d(p)} + {d(q)} AS pq",
                           f"x * m * {d(scale)} + {d(v)} AS s")
    terms = base.selectExpr("*", f"{log_gamma_text('pq')} AS g_pq", f"{log_gamma_text('px')} AS g_px", f"{digamma_text('pq')} AS d_pq",
                            f"{digamma_text('px')} AS d_px", f"{trigamma_text('pq')} AS t_pq", f"{trigamma_text('px')} AS t_px")
    fixed = q * math.log(v) - math.lgamma(q)
    first = ["x * (d_pq - d_px + ln(m) + ln(x) - ln(s))", f"d_pq + {d(math.log(v) - _digamma(q))} - ln(s)", f"{d(q / v)} - pq / s"]
    second = {(0, 0): "x * x * (t_pq - t_px)", (0, 1): "x * t_pq", (0, 2): "-x / s", (1, 1): f"t_pq - {d(_trigamma(q))}",
              (1, 2): f"{d(1 / v)} - 1 / s", (2, 2): f"{d(-q / v ** 2)} + pq / (s * s)"}
    return mean_derivatives(terms, f"g_pq - g_px + {d(fixed)} + (px - 1) * ln(m) + px * ln(x) - pq * ln(s)", first, second)


def fit_gamma_gamma(summary: DataFrame, ridge: float = 0.01, max_rounds: int = 60, scale_money: bool = True) -> DataFrame:
    """V-04: Gamma-Gamma spend model (p, q, v) on repeat buyers.

    ``scale_money`` (default) divides amounts by their mean during the fit and
    reports v in money: the ridge then weighs p, q and v alike whatever the
    currency.  Without it the same ridge number acts on v in money.  A fit that
    does not converge, or has no buyers, has ``converged = false``."""
    data = materialise(_spenders(summary), "spenders")
    stats = data.agg(F.avg("m").alias("mean"), F.sum("n").alias("n")).first()
    if not stats["n"]:
        return _params(summary, "gamma_gamma", {}, 1.0, ridge, math.nan, False, 0, 0, math.nan)
    scale = 1.0 / stats["mean"] if scale_money else 1.0
    fit = maximise(lambda theta: gamma_gamma_derivatives(data, *theta.tolist(), scale=scale), 3, ridge, stats["n"], max_rounds)
    return _fitted(summary, "gamma_gamma", fit, {"p": 1.0, "q": 1.0, "v": scale}, scale, ridge, stats["n"])


def fit_value_models(summary: DataFrame, bg_ridge: float = 1.0, gg_ridge: float = 0.01) -> DataFrame:
    """V-05: both models, one row each.  A Gamma-Gamma fit without buyers or
    without convergence is a row with ``converged = false``; the BG/NBD row
    stands."""
    return fit_bgnbd(summary, bg_ridge).unionByName(fit_gamma_gamma(summary, gg_ridge))


PARAM_SCHEMA = ("model string, params map<string,double>, scale double, ridge double, "
                "neg_log_likelihood double, converged boolean, rounds int, customers bigint, gradient double, "
                "std_error map<string,double>")


def _params(summary, model, params, scale, ridge, value, converged, rounds, n, slope, errors=None) -> DataFrame:
    row = [(model, {k: float(v) for k, v in params.items()}, float(scale), float(ridge),
            float(value), bool(converged), int(rounds), int(n), float(slope),
            {k: float(v) for k, v in (errors or {}).items()})]
    return summary.sparkSession.createDataFrame(row, PARAM_SCHEMA)


def save_parameters(params: DataFrame, path: str) -> None:
    """V-06: store fitted parameters (one row per model) as Parquet."""
    params.write.mode("overwrite").parquet(path)


def read_parameters(spark: SparkSession, path: str) -> DataFrame:
    """V-06."""
    return spark.read.parquet(path)


def parameters(params: DataFrame, model: str) -> dict[str, float]:
    row = params.where(F.col("model") == model).first()
    if row is None:
        raise ValueError(f"no {model} parameters")
    return dict(row["params"])


# --- scoring with fitted or given parameters (X-05 .. X-07) -------------------------

def p_alive(summary: DataFrame, r: float, alpha: float, a: float, b: float) -> DataFrame:
    """X-05: probability that a customer is still active; 1 without repeat
    purchases.  Rounded to 6 decimals."""
    x = F.col("frequency").cast("double")
    t, T = F.col("recency").cast("double"), F.col("T").cast("double")
    odds = (F.lit(a) / (F.lit(b) + x - 1)) * F.pow((F.lit(alpha) + T) / (F.lit(alpha) + t), F.lit(r) + x)
    p = F.when(x > 0, 1.0 / (1.0 + odds)).otherwise(F.lit(1.0))
    return summary.select("customer_id", "frequency", "recency", "T", F.round(p, 6).alias("p_alive"))


def expected_spend(summary: DataFrame, p: float, q: float, v: float) -> DataFrame:
    """X-06: expected average order value given the history,
    p (v + x m) / (p x + q - 1); null unless q > 1.  Rounded to 6 decimals."""
    return summary.select("customer_id", "frequency", "monetary_value",
                          F.round(_spend(p, q, v), 6).alias("expected_spend"))


def _terms(alpha: float, beta: float, c: float, z: float) -> int:
    """Terms after which the series of 2F1(alpha, beta; c; z), with the least
    ``c`` and the largest ``z`` that can occur, is below double precision."""
    size, total, k = 1.0, 1.0, 0
    while k < 10_000_000:
        ratio = abs((alpha + k) * (beta + k) / ((c + k) * (k + 1)) * z)
        size, k = size * ratio, k + 1
        total += size
        if size == 0.0 or (ratio < 1 and size * ratio / (1 - ratio) < 1e-17 * total):
            return k + 1
    raise ValueError("the series does not converge for these parameters")


def _hyp2f1(alpha: float, beta: float, c: F.Column, z: F.Column, terms: int) -> F.Column:
    """Gauss hypergeometric series as a column (each term from the last one)."""
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(acc, k):
        kd = k.cast("double")
        term = acc["term"] * (F.lit(alpha) + kd) * (F.lit(beta) + kd) / ((c + kd) * (kd + 1)) * z
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(terms - 1)), start, step, lambda acc: acc["total"])


def _purchases(horizon: float, r: float, alpha: float, a: float, b: float) -> F.Column:
    """Conditional expectation of BG/NBD.

    2F1(r + x, b + x; a + b + x - 1; z) = (1 - z)^(a - 1 - r - x) times
    2F1(a + b - 1 - r, a - 1; a + b + x - 1; z): the second series has small
    constant numerators, so the number of terms that double precision needs
    follows from the parameters and the horizon (x = 0, T = 0 is the slowest
    customer) and holds for every customer."""
    if a == 1.0:
        raise ValueError("the expectation is not defined for a = 1")
    x = F.col("frequency").cast("double")
    t, T = F.col("recency").cast("double"), F.col("T").cast("double")
    h = float(horizon)
    z = F.lit(h) / (F.lit(alpha) + T + F.lit(h))
    up, low = a + b - 1 - r, a - 1
    series = _hyp2f1(up, low, F.lit(a + b - 1) + x, z, _terms(up, low, a + b - 1, h / (alpha + h)))
    # (1 - z)^(r + x) of the formula cancels against the transformed power
    first = ((F.lit(a + b - 1) + x) / F.lit(a - 1)) * (1 - F.pow(1 - z, F.lit(a - 1.0)) * series)
    den = 1 + F.when(x > 0, (F.lit(a) / (F.lit(b) + x - 1)) * F.pow((F.lit(alpha) + T) / (F.lit(alpha) + t),
                                                                   F.lit(r) + x)).otherwise(F.lit(0.0))
    return first / den


def _spend(p: float, q: float, v: float) -> F.Column:
    x, m = F.col("frequency").cast("double"), F.col("monetary_value").cast("double")
    if q <= 1:
        return F.lit(None).cast("double")
    return (F.lit(p) * (F.lit(v) + x * m)) / (F.lit(p) * x + F.lit(q) - 1)


def expected_purchases(summary: DataFrame, horizon: float, r: float, alpha: float,
                       a: float, b: float) -> DataFrame:
    """X-06: expected purchases in the next ``horizon`` days given the
    history (BG/NBD conditional expectation), rounded to 6 decimals."""
    return summary.select("customer_id", "frequency", "recency", "T", "monetary_value",
                          F.round(_purchases(horizon, r, alpha, a, b), 6).alias("expected_purchases"))


def clv_holdout(orders: DataFrame, holdout_days: int, r: float, alpha: float, a: float, b: float,
                classes: int = 7) -> DataFrame:
    """V-01 / X-07 as of an earlier day: purchase histories up to ``holdout_days``
    before the last order, expected purchase days in the days held out, and the
    actual ones, by frequency class (``classes`` or more repeat days are one).

    customers, mean actual and expected purchase days, mean error and mean
    absolute error (6 decimals).  One aggregation per customer gives both sides
    of the split; a customer whose first order is held out has no history and is
    left out, one without a held-out order counts with 0."""
    known = orders.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
    day = F.to_date("order_date")
    cut = known.agg(F.date_sub(F.max(day), holdout_days).alias("c")).scalar()
    early = F.col("day") <= cut
    per = known.select("customer_id", day.alias("day")).distinct().groupBy("customer_id").agg(
        (F.count_if(early) - 1).alias("frequency"), F.min("day").alias("_first"), F.max(F.when(early, F.col("day"))).alias("_last"),
        F.count_if(~early).alias("actual"))
    history = per.where(F.col("frequency") >= 0).select(
        "frequency", F.datediff("_last", "_first").alias("recency"), (F.datediff(cut, "_first") + 1).alias("T"), "actual")
    scored = history.withColumn("expected", _purchases(float(holdout_days), r, alpha, a, b))
    error = F.col("expected") - F.col("actual")
    return scored.groupBy(F.least("frequency", F.lit(classes)).cast("int").alias("frequency_class")).agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.avg("actual"), 6).alias("actual"), F.round(F.avg("expected"), 6).alias("expected"),
        F.round(F.avg(error), 6).alias("mean_error"), F.round(F.avg(F.abs(error)), 6).alias("mean_abs_error"))


def clv_scores(summary: DataFrame, bg: dict, gg: dict, horizon: float = 365.0) -> DataFrame:
    """Customer value over ``horizon`` days: expected purchases x expected
    spend (spend falls back to the population mean without repeat days)."""
    return (summary.withColumn("expected_purchases", _purchases(horizon, bg["r"], bg["alpha"], bg["a"], bg["b"]))
            .withColumn("expected_spend", _spend(gg["p"], gg["q"], gg["v"]))
            .withColumn("clv", F.col("expected_purchases") * F.col("expected_spend")))


def clv_by_cohort(scores: DataFrame, customers: DataFrame) -> DataFrame:
    """X-07: mean and total value per signup cohort (rounded to 2 and 1 decimals)."""
    return (scores.join(customers.select("customer_id", "cohort"), "customer_id", "left")
            .groupBy("cohort").agg(F.count(F.lit(1)).alias("customers"),
                                   F.round(F.avg("clv"), 2).alias("mean_clv"),
                                   F.round(F.sum("clv"), 1).alias("total_clv")))
