"""Customer marts A-01 .. A-08.

Every mart aggregates its fact table before it meets ``customers_dim``: the
partial (map-side) aggregate absorbs a customer that holds a large share of
all orders, and the join that follows is one row per customer on both sides.
``mode="compat"`` reproduces the reference's numbers, including its fan-out
defects (D4, D7); ``mode="corrected"`` gives the intended figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import days_between

AS_OF = "2025-01-01"
DELIVERED = "Delivered"

CUSTOMER_COLS = ["customer_id", "signup_date", "cohort", "gender", "age_group",
                 "acquisition_channel", "loyalty_status"]


def _net() -> F.Column:
    return F.col("order_amount").cast("decimal(18,2)") - F.col("discount_amount").cast("decimal(18,2)")


def _dbl(c: F.Column) -> F.Column:
    return c.cast("double")


def _rfm_aggs(as_of: str) -> list[F.Column]:
    as_of_ts = F.lit(as_of).cast("timestamp")
    return [
        days_between(as_of_ts, F.max("order_date")).alias("recency_days"),
        F.count("order_id").alias("frequency"),
        _dbl(F.sum(_net())).alias("monetary"),
        (F.sum(F.col("order_amount").cast("decimal(18,2)")).cast("double")
         / F.count("order_amount")).alias("avg_order_value"),
        days_between(as_of_ts, F.min("order_date")).alias("tenure_days"),
    ]


def customer_rfm(customers: DataFrame, orders: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """A-01: recency, frequency, monetary, average order value and tenure per
    customer, days counted fractionally up to ``as_of``."""
    per_customer = orders.groupBy("customer_id").agg(*_rfm_aggs(as_of))
    return (customers.select("customer_id")
            .join(per_customer, "customer_id", "left")
            .select("customer_id", "recency_days",
                    F.coalesce("frequency", F.lit(0)).alias("frequency"),
                    "monetary", "avg_order_value", "tenure_days"))


def items_value_per_order(items: DataFrame) -> DataFrame:
    """Item rows per order: row count, value (quantity x price) and the count
    of rows with a value.  One row per order; feeds both CLV modes."""
    value = F.col("quantity").cast("decimal(20,0)") * F.col("price").cast("decimal(18,2)")
    return (items.groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("_item_rows"),
                 F.sum(value).alias("_item_value"),
                 F.count(value).alias("_item_valued")))


def _clv_terms(mode: str) -> tuple[F.Column, F.Column]:
    disc = F.col("discount_amount").cast("decimal(18,2)")
    if mode == "compat":
        # orders x items fan-out, reproduced algebraically: the order net
        # counts once per item row, the discount once per valued item row
        revenue = _net() * F.coalesce(F.col("_item_rows"), F.lit(1)).cast("decimal(20,0)")
        profit = F.when(F.col("_item_valued") > 0,
                        F.col("_item_value") - F.col("_item_valued").cast("decimal(20,0)") * disc)
    elif mode == "corrected":
        revenue = _net()
        profit = F.when(F.col("_item_valued") > 0, F.col("_item_value") - disc)
    else:
        raise ValueError(f"mode must be 'compat' or 'corrected', not {mode!r}")
    return revenue, profit


def _orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.join(items_value_per_order(items), "order_id", "left")


def customer_lifetime_value(customers: DataFrame, orders: DataFrame, items: DataFrame,
                            mode: str = "compat") -> DataFrame:
    """A-02: total revenue and "profit" per customer (D4, D5)."""
    revenue, profit = _clv_terms(mode)
    per_customer = (_orders_with_items(orders, items).groupBy("customer_id")
                    .agg(_dbl(F.sum(revenue)).alias("total_revenue"),
                         _dbl(F.sum(profit)).alias("total_profit")))
    return customers.select("customer_id").join(per_customer, "customer_id", "left")


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == DELIVERED)


def segment_profitability(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """A-03: delivered net revenue per customer and segment (inner, D6)."""
    per_customer = (_delivered(orders).groupBy("customer_id")
                    .agg(_dbl(F.sum(_net())).alias("segment_profit")))
    return (customers.select("customer_id", "age_group", "acquisition_channel", "loyalty_status")
            .join(per_customer, "customer_id", "inner"))


def _payment_pairs(orders: DataFrame) -> DataFrame:
    return (_delivered(orders).groupBy("customer_id", "payment_method")
            .agg(_dbl(F.sum(_net())).alias("revenue_payment_method")))


def revenue_by_payment(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """A-04: delivered net revenue per customer and payment method."""
    return _payment_pairs(orders).join(customers.select("customer_id"), "customer_id", "left_semi")


def repeat_purchase(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """A-05: 1 when a customer has more than one delivered order, else 0;
    customers without a delivered order have no row (D6)."""
    per_customer = (_delivered(orders).groupBy("customer_id")
                    .agg(F.when(F.count("order_id") > 1, 1).otherwise(0).alias("repeat_buyer")))
    return customers.select("customer_id").join(per_customer, "customer_id", "inner")


INTERACTION_KINDS = {"support_tickets": "support", "returns": "return", "reviews": "review"}


def _engagement_aggs() -> list[F.Column]:
    aggs = [F.count("interaction_id").alias("total_interactions")]
    for name, kind in INTERACTION_KINDS.items():
        aggs.append(F.sum(F.when(F.col("type") == kind, 1).otherwise(0)).cast("bigint").alias(name))
    return aggs


def customer_engagement(customers: DataFrame, interactions: DataFrame) -> DataFrame:
    """A-06: interaction count and support / return / review counts; 0 (not
    null) for a customer without interactions."""
    per_customer = interactions.groupBy("customer_id").agg(*_engagement_aggs())
    cols = ["total_interactions", *INTERACTION_KINDS]
    return (customers.select("customer_id").join(per_customer, "customer_id", "left")
            .select("customer_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in cols]))


def marketing_per_channel_totals(marketing: DataFrame) -> DataFrame:
    return (marketing.groupBy("channel")
            .agg(F.sum("spend").alias("_spend"),
                 F.sum("impressions").alias("_impressions"),
                 F.sum("clicks").alias("_clicks")))


def marketing_influence(customers: DataFrame, marketing: DataFrame) -> DataFrame:
    """A-07: spend, impressions and clicks of the customer's acquisition
    channel (null when the channel has no campaign).

    The reference joins customers to every campaign of their channel and then
    sums; here campaigns are summed per channel first (a handful of rows) and
    joined once, which gives the same sums without the many-to-many join."""
    per_channel = marketing_per_channel_totals(marketing).withColumnRenamed(
        "channel", "acquisition_channel")
    joined = customers.select("customer_id", "acquisition_channel").join(per_channel, "acquisition_channel", "left")
    return joined.select("customer_id", "acquisition_channel",
                         F.col("_spend").cast("double").alias("total_spend"),
                         F.col("_impressions").cast("bigint").alias("total_impressions"),
                         F.col("_clicks").cast("bigint").alias("total_clicks"))


def customer_features(inputs: dict[str, DataFrame], mode: str = "compat",
                      as_of: str = AS_OF) -> DataFrame:
    """A-08: all marts side by side, one plan.

    Orders are scanned once and grouped by (customer, payment method); those
    rows, one per method a customer uses, roll up to the customer, who keeps
    the delivered revenue per method as a list.  ``compat`` keeps one row per
    delivered payment method (D7); ``corrected`` the method with most delivered
    revenue only (ties -> smallest name)."""
    customers = inputs["customers_dim"]
    delivered = F.col("order_status") == DELIVERED
    revenue, profit = _clv_terms(mode)
    net = _net()
    by_method = (_orders_with_items(inputs["orders_fact"], inputs["order_items"])
                 .groupBy("customer_id", "payment_method")
                 .agg(F.max("order_date").alias("last"), F.count("order_id").alias("n"), F.sum(net).alias("net"),
                      F.sum(revenue).alias("revenue"), F.sum(profit).alias("profit"),
                      F.sum(F.when(delivered, net)).alias("d_net"), F.count(F.when(delivered, F.lit(1))).alias("d_rows"),
                      F.count(F.when(delivered, F.col("order_id"))).alias("d_ids")))
    method = F.struct(F.coalesce(-F.col("d_net").cast("double"), F.lit(float("inf"))).alias("k"),
                      F.col("payment_method").alias("m"), _dbl(F.col("d_net")).alias("r"))
    per_customer = by_method.groupBy("customer_id").agg(
        days_between(F.lit(as_of).cast("timestamp"), F.max("last")).alias("recency_days"),
        F.sum("n").alias("frequency"), _dbl(F.sum("net")).alias("monetary"),
        _dbl(F.sum("revenue")).alias("total_revenue"), _dbl(F.sum("profit")).alias("total_profit"),
        _dbl(F.sum("d_net")).alias("segment_profit"), F.sum("d_rows").alias("_rows"), F.sum("d_ids").alias("_ids"),
        F.collect_list(F.when(F.col("d_rows") > 0, method)).alias("_methods"))
    best = F.col("_methods") if mode == "compat" else F.slice(F.array_sort("_methods"), 1, 1)
    per_customer = per_customer.withColumn("_method", F.explode_outer(best))
    engagement = inputs["customer_interactions"].groupBy("customer_id").agg(*_engagement_aggs())
    per_channel = marketing_per_channel_totals(inputs["marketing_spend"]).withColumnRenamed(
        "channel", "acquisition_channel")
    out = (customers.select(*CUSTOMER_COLS).join(per_channel, "acquisition_channel", "left")
           .join(per_customer, "customer_id", "left").join(engagement, "customer_id", "left"))
    return out.select(
        *CUSTOMER_COLS, "recency_days",
        F.coalesce("frequency", F.lit(0)).alias("frequency"), "monetary",
        "total_revenue", "total_profit", F.when(F.col("_rows") > 0, F.col("segment_profit")).alias("segment_profit"),
        F.col("_method.m").alias("payment_method"), F.col("_method.r").alias("revenue_payment_method"),
        F.when(F.col("_rows") > 0, F.when(F.col("_ids") > 1, 1).otherwise(0)).alias("repeat_buyer"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
          for c in ("total_interactions", *INTERACTION_KINDS)],
        F.col("_spend").cast("double").alias("marketing_spend"),
        F.col("_impressions").cast("bigint").alias("total_impressions"),
        F.col("_clicks").cast("bigint").alias("total_clicks"))


def join_marts(stored: dict[str, DataFrame]) -> DataFrame:
    """J-07 from existing marts: ``customer_base`` (the customers) left-joined
    to the seven marts on customer_id, one row per delivered payment method."""
    influence = stored["marketing_influence"].select(
        "customer_id", F.col("total_spend").alias("marketing_spend"), "total_impressions", "total_clicks")
    out = stored["customer_base"]
    for mart in (stored["customer_rfm"].select("customer_id", "recency_days", "frequency", "monetary"),
                 stored["customer_lifetime_value"], stored["segment_profitability"].select("customer_id", "segment_profit"),
                 stored["revenue_by_payment"], stored["repeat_purchase"], stored["customer_engagement"], influence):
        out = out.join(mart, "customer_id", "left")
    return out.select(*CUSTOMER_COLS, *[c for c in out.columns if c not in CUSTOMER_COLS])
