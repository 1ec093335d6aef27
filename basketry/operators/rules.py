"""X-12 with joint factors: sets of order features that go with returns.

Frequent sets of features of returned orders come from Spark's FP-growth; their
counts over all orders are then taken exactly, so a set's return rate can be
compared with that of all orders.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import materialise

#: upper ends of the price bands of an order
BANDS = (("low", 50_000), ("middle", 150_000), ("high", 250_000))


def order_baskets(orders: DataFrame, items: DataFrame, products: DataFrame, returns: DataFrame) -> DataFrame:
    """order_id, returned (0/1), features (sorted, distinct): payment method,
    price band and the categories in the order (unknown ones give none)."""
    returned = returns.where(F.col("order_id").isNotNull()).select("order_id").distinct().withColumn("returned", F.lit(1))
    cats = (items.select("order_id", "product_id").join(products.select("product_id", "category"), "product_id")
            .where(F.col("category").isNotNull()).groupBy("order_id")
            .agg(F.collect_set(F.concat(F.lit("category="), "category")).alias("cats")))
    amount, band = F.col("order_amount"), F.lit("top")
    for name, end in reversed(BANDS):
        band = F.when(amount < end, F.lit(name)).otherwise(band)
    price = F.when(amount.isNotNull(), F.concat(F.lit("price="), band))
    own = F.array(F.concat(F.lit("payment="), "payment_method"), price)
    o = (orders.select("order_id", "payment_method", "order_amount").join(returned, "order_id", "left")
         .join(cats, "order_id", "left"))
    features = F.array_sort(F.array_distinct(F.array_compact(F.concat(own, F.coalesce("cats", F.array().cast("array<string>"))))))
    return o.select("order_id", F.coalesce("returned", F.lit(0)).alias("returned"), features.alias("features"))


def _subsets(features, size: int):
    """All sets of up to ``size`` of the sorted features, as sorted arrays."""
    ones = F.transform(features, lambda x: F.array(x))
    found, last = ones, ones
    for _ in range(size - 1):
        last = F.flatten(F.transform(last, lambda s: F.transform(
            F.filter(features, lambda x: x > F.element_at(s, -1)), lambda x: F.concat(s, F.array(x)))))
        found = F.concat(found, last)
    return found


def return_rules(baskets: DataFrame, min_support: float = 0.01, max_size: int = 3) -> DataFrame:
    """Sets of up to ``max_size`` features that stand in at least ``min_support``
    of the returned orders: features (joined by ' & '), size, orders and
    returned_orders with the set, return_rate, lift against the rate of all
    orders (6 decimals).

    Only frequent single features, of which there are at most (features of an
    order) / ``min_support``, pass the driver; an order's sets are counted
    before the shuffle."""
    baskets = materialise(baskets, "baskets")
    sets = FPGrowth(itemsCol="features", minSupport=min_support).fit(
        baskets.where("returned = 1").select("features")).freqItemsets.where(F.size("items") <= max_size)
    sets = materialise(sets.select(F.array_sort("items").alias("s")), "frequent")
    singles = sorted(r["x"] for r in sets.where(F.size("s") == 1).select(F.col("s")[0].alias("x")).collect())
    kept = F.array_intersect("features", F.lit(singles).cast("array<string>"))
    every = baskets.select("returned", F.array_sort(kept).alias("f")).select(
        "returned", F.explode(_subsets(F.col("f"), max_size)).alias("s"))
    counted = every.groupBy("s").agg(F.count(F.lit(1)).alias("orders"), F.sum("returned").cast("bigint").alias("returned_orders"))
    base = baskets.agg(F.avg("returned").alias("r")).scalar()
    rate = F.col("returned_orders") / F.col("orders")
    return counted.join(sets, "s").select(
        F.array_join("s", " & ").alias("features"), F.size("s").alias("size"), "orders", "returned_orders",
        F.round(rate, 6).alias("return_rate"), F.round(F.try_divide(rate, base), 6).alias("lift"))
