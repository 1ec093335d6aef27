"""X-08 with censoring: how long customers stay.

A customer is lost after their last order month once ``grace`` months without
an order have been observed; one whose last order is more recent is censored
there, so young cohorts do not look lost.  Risk sets are counts per
(group, month of life): one aggregate, then windows over as many rows as the
calendar has months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.special import chi_square_tail


def lifetimes(orders: DataFrame, grace: int = 3) -> DataFrame:
    """One row per customer with a dated order: first_month, months (from first
    to last order month), lost (1) or censored (0)."""
    month = F.trunc(F.to_date("order_date"), "month")
    known = orders.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull()).select("customer_id", month.alias("m"))
    end = known.agg(F.max("m").alias("e")).scalar()
    per = known.groupBy("customer_id").agg(F.min("m").alias("first_month"), F.max("m").alias("last"))
    return per.select("customer_id", "first_month", F.months_between("last", "first_month").cast("int").alias("months"),
                      (F.months_between(end, "last") >= grace).cast("int").alias("lost"))


def kaplan_meier(lives: DataFrame, group: str = "cohort") -> DataFrame:
    """Per group and month of life: at_risk, lost, censored, survival (share not
    lost up to and including that month) and its Greenwood std_error (null once
    nobody is left), rounded to 9 decimals."""
    per = lives.groupBy(group, "months").agg(F.count(F.lit(1)).alias("n"), F.sum("lost").cast("bigint").alias("lost"))
    later = Window.partitionBy(group).orderBy(F.desc("months")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumn("at_risk", F.sum("n").over(later))
    so_far = Window.partitionBy(group).orderBy("months").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("at_risk") - F.col("lost")
    logs = F.sum(F.when(left > 0, F.log(left / F.col("at_risk"))).otherwise(F.lit(0.0))).over(so_far)
    empty = F.max((left == 0).cast("int")).over(so_far)
    survival = F.when(empty == 1, 0.0).otherwise(F.exp(logs))
    spread = F.sum(F.when(left > 0, F.col("lost") / (F.col("at_risk") * left)).otherwise(F.lit(0.0))).over(so_far)
    return per.select(group, "months", "at_risk", "lost", (F.col("n") - F.col("lost")).alias("censored"),
                      F.round(survival, 9).alias("survival"),
                      F.when(empty == 0, F.round(survival * F.sqrt(spread), 9)).alias("std_error"))


def retention_survival(orders: DataFrame, grace: int = 3) -> DataFrame:
    """Kaplan-Meier curves by cohort (year of the first order)."""
    return kaplan_meier(lifetimes(orders, grace).withColumn("cohort", F.date_format("first_month", "yyyy")))


def log_rank(lives: DataFrame, group: str, a: str, b: str) -> DataFrame:
    """Two-group log-rank test: customers, lost and expected losses of each
    group, chi_square (6 decimals) with one degree of freedom and p_value (9);
    null where nothing is lost or the groups never meet."""
    aggs = []
    for tag, level in (("a", a), ("b", b)):
        hit = F.col(group) == level
        aggs += [F.count_if(hit).alias(f"n_{tag}"), F.sum(F.when(hit, F.col("lost")).otherwise(0)).alias(f"d_{tag}")]
    per = lives.where(F.col(group).isin(a, b)).groupBy("months").agg(*aggs)
    # as many rows as the calendar has months
    later = Window.orderBy(F.desc("months")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = per.select("*", F.sum("n_a").over(later).alias("r_a"), F.sum("n_b").over(later).alias("r_b"))
    n, d = F.col("r_a") + F.col("r_b"), F.col("d_a") + F.col("d_b")
    share = F.col("r_a") / n
    variance = F.when(n > 1, d * share * (1 - share) * (n - d) / (n - 1)).otherwise(F.lit(0.0))
    out = r.agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.sum("d_a").alias("lost_a"), F.sum("d_b").alias("lost_b"),
                F.sum(d * share).alias("e"), F.sum(d * (1 - share)).alias("f"), F.sum(variance).alias("v"))
    x = F.try_divide((F.col("lost_a") - F.col("e")) * (F.col("lost_a") - F.col("e")), F.col("v"))
    return out.select(F.lit(a).alias("group_a"), F.lit(b).alias("group_b"), "n_a", "n_b", "lost_a", "lost_b",
                      F.round("e", 6).alias("expected_a"), F.round("f", 6).alias("expected_b"), F.round(x, 6).alias("chi_square"),
                      F.round(chi_square_tail(x, F.lit(1.0)), 9).alias("p_value"))
