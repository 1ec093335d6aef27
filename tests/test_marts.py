import datetime as dt
from decimal import Decimal as D

from conftest import CUST_SCHEMA, ITEM_SCHEMA, ORDER_SCHEMA

from basketry.operators import marts

T0 = dt.datetime(2024, 1, 1)


def _customers(spark, ids):
    return spark.createDataFrame([(i, T0, "2024-01", "F", "18-25", "WEB", "Gold") for i in ids], CUST_SCHEMA)


def test_clv_compat_counts_order_once_per_item(spark):
    cust = _customers(spark, ["c1"])
    orders = spark.createDataFrame([("o1", "c1", T0, D("100.00"), D("10.00"), "Delivered", "card")], ORDER_SCHEMA)
    items = spark.createDataFrame([(f"i{k}", "o1", "p", 1, D("30.00")) for k in range(3)], ITEM_SCHEMA)
    compat = marts.customer_lifetime_value(cust, orders, items).first()
    fixed = marts.customer_lifetime_value(cust, orders, items, mode="corrected").first()
    assert compat["total_revenue"] == 270.0 and compat["total_profit"] == 60.0
    assert fixed["total_revenue"] == 90.0 and fixed["total_profit"] == 80.0


def test_rfm_customer_without_orders(spark):
    cust = _customers(spark, ["c1", "c2"])
    orders = spark.createDataFrame([("o1", "c1", dt.datetime(2024, 1, 8, 12), D("5.00"), D("1.00"), "Shipped", "card")],
                                   ORDER_SCHEMA)
    rows = {r["customer_id"]: r for r in marts.customer_rfm(cust, orders).collect()}
    assert rows["c1"]["recency_days"] == 358.5 and rows["c1"]["frequency"] == 1
    assert rows["c1"]["monetary"] == 4.0
    assert rows["c2"]["frequency"] == 0 and rows["c2"]["monetary"] is None


def test_engagement_zero_not_null(spark):
    cust = _customers(spark, ["c1"])
    inter = spark.createDataFrame([], "interaction_id string, customer_id string, type string, text string")
    r = marts.customer_engagement(cust, inter).first()
    assert (r["total_interactions"], r["support_tickets"], r["returns"], r["reviews"]) == (0, 0, 0, 0)


def test_marketing_missing_channel_is_null(spark):
    cust = _customers(spark, ["c1"])
    mk = spark.createDataFrame([("m1", "TV", D("5.00"), 10, 1)],
                               "campaign_id string, channel string, spend decimal(18,2), impressions bigint, clicks bigint")
    r = marts.marketing_influence(cust, mk).first()
    assert r["total_spend"] is None and r["total_clicks"] is None


def test_features_payment_fanout(spark):
    cust = _customers(spark, ["c1"])
    orders = spark.createDataFrame([
        ("o1", "c1", T0, D("10.00"), D("0.00"), "Delivered", "card"),
        ("o2", "c1", T0, D("30.00"), D("0.00"), "Delivered", "cash"),
    ], ORDER_SCHEMA)
    empty_items = spark.createDataFrame([], ITEM_SCHEMA)
    inputs = {
        "customers_dim": cust, "orders_fact": orders, "order_items": empty_items,
        "customer_interactions": spark.createDataFrame([], "interaction_id string, customer_id string, type string, text string"),
        "marketing_spend": spark.createDataFrame([], "campaign_id string, channel string, spend decimal(18,2), impressions bigint, clicks bigint"),
    }
    compat = marts.customer_features(inputs).collect()
    one = marts.customer_features(inputs, mode="corrected").collect()
    assert len(compat) == 2 and len(one) == 1
    assert one[0]["payment_method"] == "cash" and one[0]["revenue_payment_method"] == 30.0
    assert one[0]["repeat_buyer"] == 1 and one[0]["total_revenue"] == 40.0
