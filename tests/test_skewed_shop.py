"""A shop where one customer places a third of all orders and one order
holds a third of all items: results must equal a brute-force pandas
computation (the operators pre-aggregate; nothing is capped or sampled)."""

import datetime as dt
import random
from decimal import Decimal

import pandas as pd

from conftest import CUST_SCHEMA, ITEM_SCHEMA, ORDER_SCHEMA

from basketry.operators import marts, summaries


def _shop(spark):
    rnd = random.Random(5)
    customers = [(f"c{i}", dt.datetime(2020, 1, 1), "2020-01", "F", "18-25", "WEB", "Gold") for i in range(30)]
    orders, items = [], []
    for o in range(900):
        cust = "c0" if o % 3 == 0 else f"c{rnd.randint(1, 29)}"
        orders.append((f"o{o}", cust, dt.datetime(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 900)),
                       Decimal(rnd.randint(100, 99999)) / 100, Decimal(rnd.randint(0, 500)) / 100,
                       "Delivered" if o % 4 else "Shipped", rnd.choice(["card", "cash"])))
    n_items = 3000
    for k in range(n_items):
        order = "o0" if k % 3 == 0 else f"o{rnd.randint(1, 899)}"
        items.append((f"i{k}", order, f"p{rnd.randint(0, 40)}", rnd.randint(1, 5), Decimal(rnd.randint(100, 9999)) / 100))
    return (spark.createDataFrame(customers, CUST_SCHEMA), spark.createDataFrame(orders, ORDER_SCHEMA),
            spark.createDataFrame(items, ITEM_SCHEMA), orders, items)


def test_hot_customer_and_hot_order(spark):
    cust, ords, its, orders, items = _shop(spark)
    po = pd.DataFrame(orders, columns=["order_id", "customer_id", "order_date", "order_amount", "discount_amount",
                                       "order_status", "payment_method"])
    pi = pd.DataFrame(items, columns=["order_item_id", "order_id", "product_id", "quantity", "price"])
    for frame, cols in ((po, ["order_amount", "discount_amount"]), (pi, ["price"])):
        frame[cols] = frame[cols].astype(float)

    # compat lifetime value: the reference's orders x items fan-out, by brute force
    fan = po.merge(pi, on="order_id", how="left")
    fan["rev"] = fan["order_amount"] - fan["discount_amount"]
    fan["profit"] = fan["quantity"] * fan["price"] - fan["discount_amount"]
    want = fan.groupby("customer_id").agg(rev=("rev", "sum"), profit=("profit", "sum"))
    got = {r["customer_id"]: r for r in marts.customer_lifetime_value(cust, ords, its).collect()}
    for c, row in want.iterrows():
        assert abs(got[c]["total_revenue"] - row["rev"]) < 1e-9 * max(1.0, abs(row["rev"]))
        assert abs(got[c]["total_profit"] - row["profit"]) < 1e-9 * max(1.0, abs(row["profit"]))

    # items per customer through the hot order
    link = pi.merge(po[["order_id", "customer_id"]], on="order_id")
    want_items = link.groupby("customer_id").agg(n=("order_item_id", "count"), u=("product_id", "nunique"),
                                                 q=("quantity", "sum"))
    got_items = {r["customer_id"]: r for r in summaries.items_per_customer(its, ords).collect()}
    for c, row in want_items.iterrows():
        assert (got_items[c]["total_items"], got_items[c]["unique_products"], got_items[c]["total_quantity"]) == \
            (row["n"], row["u"], row["q"])
