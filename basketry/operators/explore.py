"""Exploration: KPIs, distributions, counts, time series, top-k
(A-18 .. A-22, T-01 .. T-05, X-14).

Money is summed as decimal and turned into double last, so totals do not
depend on the order in which partitions are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import has
from basketry.operators.quantiles import column_quantiles

HIST_BINS = 50


def _money_sum(c: str) -> F.Column:
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def order_kpis(orders: DataFrame) -> DataFrame:
    """A-18: total orders, revenue, average order value, total returns (0 when
    the column is absent)."""
    returns = (F.coalesce(F.sum("num_returns").cast("double"), F.lit(0.0))
               if has(orders, "num_returns") else F.lit(0.0))
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(_money_sum("order_amount"), F.lit(0.0)).alias("total_revenue"),
        (_money_sum("order_amount") / F.count("order_amount")).alias("avg_order_value"),
        returns.alias("total_returns"))


def customer_describe(customers: DataFrame, cols=("num_orders", "total_order_amount")) -> DataFrame:
    """A-19: count, mean, sample std, min, quartiles and max per column, one
    row per column (exact quartiles by the distributed quantile, linear
    interpolation).  Mean, std and quartiles are rounded to 6 decimals."""
    cols = list(cols)
    quart = column_quantiles(customers, cols, [0.25, 0.5, 0.75])
    six = lambda v: F.lit(None if v is None else round(v, 6)).cast("double")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count(x).alias("count"),
            F.round(F.sum(F.col(c).cast("decimal(38,6)")).cast("double") / F.count(x), 6).alias("mean"),
            F.round(F.stddev_samp(x), 6).alias("std"), F.min(x).alias("min"), six(quart[c][0]).alias("p25"),
            six(quart[c][1]).alias("p50"), six(quart[c][2]).alias("p75"), F.max(x).alias("max")))
    return customers.agg(F.array(*aggs).alias("a")).select(F.explode("a").alias("r")).select("r.*")


def histogram(df: DataFrame, col: str, bins: int = HIST_BINS) -> DataFrame:
    """A-20: equal-width bins between min and max (the last bin closed), one
    row per non-empty bin: bin, bin_start, bin_end, count."""
    x = F.col(col).cast("double")
    bounds = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, count bigint")
    width = (hi - lo) / bins
    if width > 0:
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    else:
        b = F.lit(0)
    w = F.lit(width)
    return (df.where(x.isNotNull()).groupBy(b.alias("bin")).count()
            .select("bin", (F.lit(lo) + F.col("bin") * w).alias("bin_start"),
                    (F.lit(lo) + (F.col("bin") + 1) * w).alias("bin_end"), "count"))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """A-21: rows per value of ``col`` (nulls dropped), most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), F.asc(col)))


def cohort_sizes(customers: DataFrame) -> DataFrame:
    """T-03 (D19): customers per signup month ``yyyy-MM``."""
    month = F.date_format("signup_date", "yyyy-MM")
    return (customers.where(F.col("signup_date").isNotNull())
            .groupBy(month.alias("signup_month")).agg(F.count(F.lit(1)).alias("cohort_size"))
            .orderBy("signup_month"))


def _period(freq: str):
    """(label of a date, step of the calendar) for D / W / M.  ``W`` labels a
    week by its closing Sunday, ``M`` a month by its last day."""
    d = F.to_date("order_date")
    if freq == "D":
        return d, "INTERVAL 1 DAY"
    if freq == "W":
        return F.next_day(F.date_sub(d, 1), "Sun"), "INTERVAL 7 DAY"
    if freq == "M":
        return F.last_day(d), None
    raise ValueError(f"freq must be D, W or M, not {freq!r}")


def _by_period(orders: DataFrame, freq: str, value: F.Column, name: str) -> DataFrame:
    label, step = _period(freq)
    per = (orders.where(F.col("order_date").isNotNull())
           .groupBy(label.alias("period")).agg(value.alias(name)))
    # one row holds all periods (as many as the calendar has, whatever the
    # amount of data): bounds, spine and values come from one pass
    whole = per.agg(F.min("period").alias("a"), F.max("period").alias("b"),
                    F.map_from_entries(F.collect_list(F.struct("period", name))).alias("values"))
    if step is None:
        seq = F.transform(F.sequence(F.trunc("a", "month"), F.trunc("b", "month"),
                                     F.expr("INTERVAL 1 MONTH")), lambda m: F.last_day(m))
    else:
        seq = F.sequence("a", "b", F.expr(step))
    return (whole.select(F.explode(seq).alias("period"), "values")
            .select(F.col("period").cast("timestamp").alias("order_date"),
                    F.coalesce(F.col("values")[F.col("period")], F.lit(0)).alias(name))
            .orderBy("order_date"))


def revenue_by_period(orders: DataFrame, freq: str = "D") -> DataFrame:
    """T-01: revenue per day / week / month, empty periods 0."""
    return _by_period(orders, freq, F.sum(F.col("order_amount").cast("decimal(18,2)")).cast("double"),
                      "order_amount")


def orders_by_period(orders: DataFrame, freq: str = "D") -> DataFrame:
    """X-14: order count per period beside revenue, empty periods 0."""
    return _by_period(orders, freq, F.count(F.lit(1)), "num_orders")


def top_categories(orders: DataFrame, n: int = 10) -> DataFrame | None:
    """T-04: the ``n`` category lists with most revenue (ties by name);
    ``None`` without a categories column."""
    if not has(orders, "categories"):
        return None
    # an empty list is no category (it reads back as missing from CSV)
    return (orders.where(F.col("categories") != "").groupBy("categories")
            .agg(_money_sum("order_amount").alias("order_amount"))
            .orderBy(F.desc("order_amount"), F.asc("categories")).limit(n))


def returns_by_reason(orders: DataFrame, n: int = 10, sep: str = ";",
                      mode: str = "compat") -> DataFrame | None:
    """T-05 (D9): split the reason lists on ``sep``, count each reason, top
    ``n``.  ``compat`` counts a missing list as the word 'nan' like the
    reference; ``corrected`` leaves it out."""
    if not has(orders, "return_reasons"):
        return None
    # an empty list reads back from CSV as missing: the reference then
    # counts it as the word 'nan'
    text = F.nullif(F.col("return_reasons").cast("string"), F.lit(""))
    if mode == "compat":
        src = orders.select(F.coalesce(text, F.lit("nan")).alias("r"))
    elif mode == "corrected":
        src = orders.where(text.isNotNull()).select(text.alias("r"))
    else:
        raise ValueError(f"mode must be 'compat' or 'corrected', not {mode!r}")
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return (src.select(F.explode(F.split("r", pattern)).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("reason")).limit(n))
