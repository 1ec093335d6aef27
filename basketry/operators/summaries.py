"""Order- and customer-grain summaries (A-09 .. A-17).

Side tables are aggregated on their own key first (partial aggregation on
the map side), so each later join is at most one row per key on the side
that is joined in; link joins (items -> orders) run on pre-aggregated items.
Distinct text lists are sorted before joining (D15).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators import fills
from basketry.schemas import (CUSTOMER_MODE_FILL, CUSTOMER_NUMERIC_FILL, ORDER_DOUBLE, ORDER_MODE_FILL,
                              ORDER_NUMERIC_FILL, ORDER_SIDE_ITEMS, ORDER_SIDE_RETURNS, SIDE_CHANNEL,
                              SIDE_CUSTOMER_ITEMS, SIDE_CUSTOMER_ORDERS, SIDE_CUSTOMER_RETURNS, SIDE_INTERACTIONS)
from basketry.session import materialise


def _psum(c: str) -> F.Column:
    """pandas-style sum: an all-null group sums to 0."""
    return F.coalesce(F.sum(c), F.lit(0))


def _join_text(arr: F.Column, sep: str) -> F.Column:
    return F.array_join(F.array_sort(arr), sep)


def _text_set(c: str, sep: str) -> F.Column:
    """Sorted distinct non-null values joined by ``sep``; '' when a group has
    none (what joining an empty set gives)."""
    return _join_text(F.collect_set(F.col(c).cast("string")), sep)


def items_per_order(items: DataFrame, products: DataFrame) -> DataFrame:
    """A-09: items and their products per order.

    An order gathers its distinct products once, each with its categories; the
    three text sets are taken from those (nulls do not show in joined texts)."""
    prod = products.select("product_id", "category", "subcategory")
    joined = items.where(F.col("order_id").isNotNull()).join(prod, "product_id", "left")
    own = F.struct(*[F.col(c).cast("string").alias(c) for c in ("product_id", "category", "subcategory")])
    gathered = joined.groupBy("order_id").agg(
        F.count("order_item_id").alias("num_items"), F.collect_set(own).alias("_products"),
        _psum("quantity").cast("bigint").alias("total_quantity"), _psum("price").cast("double").alias("total_item_price"))

    def texts(c: str, name: str) -> F.Column:
        return _join_text(F.array_distinct(F.col("_products")[c]), ",").alias(name)

    return gathered.select(
        "order_id", "num_items", texts("product_id", "products_in_order"), "total_quantity", "total_item_price",
        texts("category", "categories"), texts("subcategory", "subcategories"))


def returns_per_order(returns: DataFrame, with_dates: bool = False) -> DataFrame:
    """A-10: return count, return dates and reasons per order.  The dates are
    text joined by ',' as in the reference; ``with_dates`` adds the typed
    first and last date (D10)."""
    aggs = [F.count("return_id").alias("num_returns"),
            _text_set("return_date", ",").alias("return_date"),
            _text_set("reason", ",").alias("return_reasons")]
    if with_dates:
        aggs += [F.min("return_date").alias("first_return_date"),
                 F.max("return_date").alias("last_return_date")]
    return returns.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(*aggs)


def interactions_per_customer(interactions: DataFrame, type_sep: str = ",",
                              text_sep: str = " | ") -> DataFrame:
    """A-11: interaction count, distinct types and distinct texts per customer.

    Texts are de-duplicated per (customer, text) in a shuffle of their own
    before they are gathered, so repeated texts of a busy customer never sit
    in one buffer; the gathered list is each customer's distinct texts only."""
    base = interactions.where(F.col("customer_id").isNotNull())
    counts = base.groupBy("customer_id").agg(
        F.count("interaction_id").alias("num_interactions"),
        _text_set("type", type_sep).alias("interaction_types"))
    texts = (base.where(F.col("text").isNotNull()).select("customer_id", "text").distinct()
             .groupBy("customer_id").agg(F.collect_list("text").alias("_texts")))
    return (counts.join(texts, "customer_id", "left")
            .select("customer_id", "num_interactions", "interaction_types",
                    _join_text(F.coalesce("_texts", F.array().cast("array<string>")), text_sep)
                    .alias("interaction_texts")))


def marketing_per_channel(marketing: DataFrame) -> DataFrame:
    """A-12: campaigns, spend, impressions and clicks per channel."""
    return marketing.where(F.col("channel").isNotNull()).groupBy("channel").agg(
        F.count("campaign_id").alias("num_campaigns"),
        _psum("spend").cast("double").alias("total_spend"),
        _psum("impressions").cast("bigint").alias("total_impressions"),
        _psum("clicks").cast("bigint").alias("total_clicks"))


def orders_per_customer(orders: DataFrame) -> DataFrame:
    """A-13: order count, amount and discounts per customer."""
    return orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count("order_id").alias("num_orders"),
        _psum("order_amount").cast("double").alias("total_order_amount"),
        _psum("discount_amount").cast("double").alias("total_discounts"))


def _order_link(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "customer_id").where(F.col("order_id").isNotNull())


def items_per_customer(items: DataFrame, orders: DataFrame) -> DataFrame:
    """A-14: item rows, distinct products, quantity and price per customer.

    Items are first reduced to one row per (order, product) with their counts
    and sums (partial aggregation absorbs an order or product with very many
    rows); those rows meet the order -> customer link once, and one
    aggregation per customer gives the sums and the distinct product count
    (a busy customer holds at most one entry per product)."""
    pairs = (items.where(F.col("order_id").isNotNull())
             .groupBy("order_id", "product_id")
             .agg(F.count("order_item_id").alias("n"), F.sum("quantity").alias("q"),
                  F.sum("price").alias("p")))
    return (pairs.join(_order_link(orders), "order_id", "inner")
            .where(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.sum("n").alias("total_items"),
                 F.count_distinct("product_id").alias("unique_products"),
                 F.coalesce(F.sum("q"), F.lit(0)).cast("bigint").alias("total_quantity"),
                 F.coalesce(F.sum("p"), F.lit(0)).cast("double").alias("total_item_price")))


def returns_per_customer(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """A-15: return count and distinct reasons per customer (via orders).

    Returns are reduced per order first (count, distinct reasons), linked to
    customers once, and the reasons are gathered with a set: a customer's
    buffer holds its distinct reasons, never one entry per order."""
    per_order = returns.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.count("return_id").alias("n"), F.collect_set("reason").alias("r"))
    linked = (per_order.join(_order_link(orders), "order_id", "inner")
              .where(F.col("customer_id").isNotNull()))
    # one row per (order, reason); the order's count rides on its first row
    rows = linked.select("customer_id", "n", F.posexplode_outer("r").alias("pos", "reason"))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    return rows.groupBy("customer_id").agg(
        F.sum(F.when(first, F.col("n"))).alias("total_returns"),
        _text_set("reason", ",").alias("return_reasons"))


def _as_double(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns that a left join can leave null, and money, as double (as in a
    pandas frame after a left merge)."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


FILLS = ("stat", "median", "mode", "zero", "none")


def _fill(df: DataFrame, numeric: list[str], text: list[str], fill: str, narrow) -> DataFrame:
    """Fill the listed columns.  ``narrow`` yields (weighted rows, their columns)
    per side; medians and modes come from those, before any wide join."""
    if fill not in FILLS:
        raise ValueError(f"fill must be one of {FILLS}, not {fill!r}")
    if fill == "zero":
        return fills.zero_fill(df, numeric)
    medians, table = _together(
        lambda: fills.weighted_medians(_united(narrow, numeric, "double")) if fill in ("stat", "median") and numeric else None,
        lambda: materialise(fills.mode_table(_united(narrow, text, "string")), "modes") if fill in ("stat", "mode") and text else None)
    if medians is not None:
        df = fills.fill_medians(df, {c: medians.get(c) for c in numeric})
    return df if table is None else fills.fill_modes(df, table, text, written=True)


def _together(*steps: Callable) -> list:
    """Results of independent steps, whose jobs run at the same time."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return list(pool.map(lambda step: step(), steps))


def _filled(numeric: list[str], text: list[str], fill: str) -> set[str]:
    """Columns whose fill value is a statistic of the data."""
    return set(numeric if fill in ("stat", "median") else []) | set(text if fill in ("stat", "mode") else [])


def _once(build, key: str, own: list[str], wanted: set[str], filled: set[str], label: str):
    """A side as a function.  One with fill values is read by them and by the
    join: it is written once, with the columns wanted of it, and read back."""
    kept: list[DataFrame] = []

    def side() -> DataFrame:
        if not filled & set(own):
            return build()
        if not kept:
            kept.append(materialise(build().select(key, *[c for c in own if c in wanted]), label))
        return kept[0]

    return side


def _united(narrow, cols: list[str], kind: str) -> DataFrame:
    out = None
    for side, own in narrow:
        mine = [c for c in cols if c in own]
        if mine:
            part = fills.stacked(side(), mine, kind, "_w")
            out = part if out is None else out.unionByName(part)
    return out


def _channels(marketing: DataFrame) -> DataFrame:
    per_channel = marketing_per_channel(marketing)
    return per_channel.withColumn("acquisition_channel", F.col("channel"))


def _limited(cols: list[str], columns: list[str] | None, what: str) -> list[str]:
    if columns is None:
        return cols
    unknown = set(columns) - set(cols)
    if unknown:
        raise ValueError(f"unknown {what} summary columns: {sorted(unknown)}")
    return [c for c in cols if c in columns]


def order_summary(inputs: dict[str, DataFrame], fill: str = "stat",
                  columns: list[str] | None = None) -> DataFrame:
    """A-16: one row per order with customer, item, return, interaction and
    channel-marketing columns, then the fills of the reference (D8:
    ``fill="stat"`` gives unreturned orders the median return count and the
    most common return date and reason; ``fill="zero"`` does not; "median" and
    "mode" fill numbers or texts only).

    Plan: order-grain sides join on ``order_id`` (items and returns are
    already one row per order and share that partitioning), then one join on
    ``customer_id`` brings a pre-joined customer side (customer columns,
    interactions, channel marketing).  ``columns`` limits the output and the
    sides built; every side is one row per order or customer, so the rows and
    the fill values stay the same.  Fill values of a side are taken from that
    side alone, weighted by the orders that meet it."""
    orders, customers = inputs["orders_fact"], inputs["customers_dim"]
    cols = _limited(orders.columns + [c for c in customers.columns if c != "customer_id"]
                    + ORDER_SIDE_ITEMS + ORDER_SIDE_RETURNS + SIDE_INTERACTIONS + SIDE_CHANNEL, columns, "order")
    wanted = set(cols)

    numeric, text = ([c for c in fillable if c in wanted] for fillable in (ORDER_NUMERIC_FILL, ORDER_MODE_FILL))
    filled = _filled(numeric, text, fill)
    returns = _once(lambda: returns_per_order(inputs["returns_refunds"]), "order_id", ORDER_SIDE_RETURNS, wanted, filled, "returns")
    interactions = _once(lambda: interactions_per_customer(inputs["customer_interactions"]), "customer_id", SIDE_INTERACTIONS,
                         wanted, filled, "interactions")
    channels = _once(lambda: _channels(inputs["marketing_spend"]), "acquisition_channel", SIDE_CHANNEL, wanted, filled, "channels")

    per_customer = _once(lambda: orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_w")).join(
        customers.select("customer_id", "acquisition_channel"), "customer_id"), "customer_id", ["acquisition_channel", "_w"],
        {"acquisition_channel", "_w"}, {"_w"} if filled & set(SIDE_INTERACTIONS + SIDE_CHANNEL) else set(), "weights")
    _together(returns, interactions, channels, per_customer)

    joined = orders
    if wanted & set(ORDER_SIDE_ITEMS):
        joined = joined.join(items_per_order(inputs["order_items"], inputs["products_dim"]), "order_id", "left")
    if wanted & set(ORDER_SIDE_RETURNS):
        joined = joined.join(returns(), "order_id", "left")
    if wanted - set(orders.columns) - set(ORDER_SIDE_ITEMS) - set(ORDER_SIDE_RETURNS):
        side = customers
        if wanted & set(SIDE_INTERACTIONS):
            side = side.join(interactions(), "customer_id", "left")
        if wanted & set(SIDE_CHANNEL):
            side = side.join(channels(), "acquisition_channel", "left")
        joined = joined.join(side, "customer_id", "left")
    out = _as_double(joined.select(*cols), [c for c in ORDER_DOUBLE if c in wanted])

    narrow = [
        (lambda: orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("_w")).join(returns(), "order_id"), ORDER_SIDE_RETURNS),
        (lambda: per_customer().join(interactions(), "customer_id"), SIDE_INTERACTIONS),
        (lambda: per_customer().groupBy("acquisition_channel").agg(F.sum("_w").alias("_w")).join(
            channels(), "acquisition_channel"), SIDE_CHANNEL)]
    return _fill(out, numeric, text, fill, narrow)


def customer_summary(inputs: dict[str, DataFrame], fill: str = "stat",
                     columns: list[str] | None = None) -> DataFrame:
    """A-17: one row per customer with order, item, return, interaction and
    channel-marketing totals, then the reference's median / mode fills.
    ``columns`` and the fills work as in ``order_summary``."""
    customers, orders = inputs["customers_dim"], inputs["orders_fact"]
    sides = [
        (lambda: orders_per_customer(orders), SIDE_CUSTOMER_ORDERS),
        (lambda: items_per_customer(inputs["order_items"], orders), SIDE_CUSTOMER_ITEMS),
        (lambda: returns_per_customer(inputs["returns_refunds"], orders), SIDE_CUSTOMER_RETURNS),
        (lambda: interactions_per_customer(inputs["customer_interactions"]), SIDE_INTERACTIONS)]
    cols = _limited(customers.columns + [c for _, own in sides for c in own] + SIDE_CHANNEL, columns, "customer")
    wanted = set(cols)
    numeric, text = ([c for c in fillable if c in wanted] for fillable in (CUSTOMER_NUMERIC_FILL, CUSTOMER_MODE_FILL))
    filled = _filled(numeric, text, fill)
    sides = [(_once(build, "customer_id", own, wanted, filled, "side"), own) for build, own in sides]
    channels = _once(lambda: _channels(inputs["marketing_spend"]), "acquisition_channel", SIDE_CHANNEL, wanted, filled, "channels")
    _together(channels, *(side for side, _ in sides))
    joined = customers
    for side, own in sides:
        if wanted & set(own):
            joined = joined.join(side(), "customer_id", "left")
    if wanted & set(SIDE_CHANNEL):
        joined = joined.join(channels(), "acquisition_channel", "left")
    out = _as_double(joined.select(*cols), numeric)

    def counted(key: str):
        return customers.groupBy(key).agg(F.count(F.lit(1)).alias("_w"))

    narrow = [(lambda side=side: counted("customer_id").join(side(), "customer_id"), own) for side, own in sides]
    narrow.append((lambda: counted("acquisition_channel").join(channels(), "acquisition_channel"), SIDE_CHANNEL))
    return _fill(out, numeric, text, fill, narrow)
