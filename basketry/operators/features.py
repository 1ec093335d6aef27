"""Customer features F-01 .. F-05."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import has, safe_div
from basketry.operators.quantiles import column_quantiles, grouped_quantiles

# Bucket labels and cut points.
BUCKET_LABELS = ["low", "mid", "high", "very_high"]
QUARTILES = [0.0, 0.25, 0.5, 0.75, 1.0]


def last_order_date(orders: DataFrame) -> DataFrame:
    """A-24: last order per customer."""
    return (orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id")
            .agg(F.max("order_date").alias("last_order_date")))


def customer_ratio_features(customers: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """F-01 .. F-04: average order value, return rate and interactions per
    order (0 when there is no order), and the last order date when orders are
    given.  Columns that are absent are skipped (PF-07)."""
    out = {}
    if has(customers, "num_orders"):
        out["avg_order_value"] = safe_div("total_order_amount", "num_orders")
        if has(customers, "total_returns"):
            out["return_rate"] = safe_div("total_returns", "num_orders")
        if has(customers, "num_interactions"):
            out["interaction_per_order"] = safe_div("num_interactions", "num_orders")
    df = customers.withColumns(out) if out else customers
    if orders is not None:
        df = df.join(last_order_date(orders), "customer_id", "left")
    return df


def quartile_edges(df: DataFrame, col: str = "total_order_amount") -> list[float]:
    """Quartile edges (0, 25, 50, 75, 100 %, linear interpolation) of a
    column, duplicates dropped (distributed exact quantiles)."""
    qs = column_quantiles(df, [col], QUARTILES)[col]
    return sorted({float(x) for x in qs if x is not None})


def bucket_column(x: F.Column, edges: list[float], labels: list[str]) -> F.Column:
    """F-S15: right-closed bins over ``edges``, the lowest edge included; null
    outside the edges or when there is no bin."""
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = (x >= lo) & (x <= hi) if i == 0 else (x > lo) & (x <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr if expr is not None else F.lit(None).cast("string")


def ltv_buckets(customers: DataFrame, col: str = "total_order_amount") -> DataFrame:
    """F-05: value buckets low / mid / high / very_high cut at the quartiles
    of ``col`` (duplicate edges dropped, labels shortened to match); also
    the average order value with a zero order count kept null."""
    edges = quartile_edges(customers, col)
    labels = BUCKET_LABELS[: max(len(edges) - 1, 0)]
    x = F.col(col).cast("double")
    return customers.select(
        "customer_id", x.alias(col),
        safe_div(col, "num_orders", zero=None).alias("avg_order_value"),
        bucket_column(x, edges, labels).alias("ltv_bucket"))


def ltv_bucket_box(customers: DataFrame, col: str = "total_order_amount") -> DataFrame:
    """A-22: five-number summary and count of ``col`` per value bucket.
    Quartiles per bucket come from the distributed exact quantile (a bucket
    holds a quarter of all customers: too many values for one buffer) and
    return to the plan as literals."""
    b = ltv_buckets(customers, col)
    q = grouped_quantiles(b.select(F.col("ltv_bucket").alias("g"), F.col(col).alias("v"))
                          .where(F.col("g").isNotNull()), [0.25, 0.5, 0.75])

    def pick(i):
        expr = F.lit(None).cast("double")
        for label, vals in q.items():
            expr = F.when(F.col("ltv_bucket") == label, F.lit(round(vals[i], 6))).otherwise(expr)
        return expr

    return (b.groupBy("ltv_bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("min"), F.max(col).alias("max"))
            .select("ltv_bucket", "n", "min", pick(0).alias("q1"), pick(1).alias("median"),
                    pick(2).alias("q3"), "max"))
