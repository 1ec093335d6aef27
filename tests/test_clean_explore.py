import datetime as dt

from basketry.operators import clean, explore, features


def test_clean_customers_bad_number_and_words(spark):
    df = spark.createDataFrame([("c1", "x", None, None), ("c2", "3.5", "M", "Gold")],
                               "customer_id string, num_orders string, gender string, loyalty_status string")
    rows = {r["customer_id"]: r for r in clean.clean_customers(df).collect()}
    assert rows["c1"]["num_orders"] == 0.0 and rows["c2"]["num_orders"] == 3.5
    assert rows["c1"]["gender"] == "Unknown" and rows["c1"]["loyalty_status"] == "None"


def test_clean_absent_column_stays_null(spark):
    df = spark.createDataFrame([("c1",)], "customer_id string")
    r = clean.clean_customers(df).first()
    assert r["gender"] is None and r["loyalty_status"] is None


def test_clean_orders_unknown_categories(spark):
    df = spark.createDataFrame([(None, "bad")], "categories string, num_items string")
    r = clean.clean_orders(df).first()
    assert r["categories"] == "Unknown" and r["num_items"] == 0.0


def _orders(spark, dates, amounts):
    return spark.createDataFrame([(dt.datetime.fromisoformat(d), float(a)) for d, a in zip(dates, amounts)],
                                 "order_date timestamp, order_amount double")


def test_daily_gap_is_zero(spark):
    got = explore.revenue_by_period(_orders(spark, ["2024-01-01", "2024-01-03"], [1, 2]), "D").collect()
    assert [r["order_amount"] for r in got] == [1.0, 0.0, 2.0]


def test_month_and_week_labels(spark):
    o = _orders(spark, ["2024-01-31", "2024-03-01"], [1, 2])
    m = [(r["order_date"].date().isoformat(), r["order_amount"]) for r in explore.revenue_by_period(o, "M").collect()]
    assert m == [("2024-01-31", 1.0), ("2024-02-29", 0.0), ("2024-03-31", 2.0)]
    w = explore.revenue_by_period(_orders(spark, ["2024-01-07", "2024-01-08"], [1, 2]), "W").collect()
    # 2024-01-07 is a Sunday: it closes its own week
    assert [r["order_date"].date().isoformat() for r in w] == ["2024-01-07", "2024-01-14"]


def test_returns_by_reason_modes(spark):
    df = spark.createDataFrame([("late;damaged",), ("late,damaged",), (None,)], "return_reasons string")
    compat = {r["reason"]: r["count"] for r in explore.returns_by_reason(df).collect()}
    assert compat == {"late": 1, "damaged": 1, "late,damaged": 1, "nan": 1}
    fixed = {r["reason"]: r["count"] for r in explore.returns_by_reason(df, sep=",", mode="corrected").collect()}
    assert fixed == {"late;damaged": 1, "late": 1, "damaged": 1}


def test_bucket_edges(spark):
    df = spark.createDataFrame([(f"c{i}", float(v), 1) for i, v in enumerate([0, 0, 0, 0, 0, 1, 2])],
                               "customer_id string, total_order_amount double, num_orders int")
    assert features.quartile_edges(df) == [0.0, 0.5, 2.0]
    labels = [r["ltv_bucket"] for r in features.ltv_buckets(df).orderBy("customer_id").collect()]
    assert labels == ["low"] * 5 + ["mid", "mid"]


def test_all_equal_totals_have_no_bucket(spark):
    df = spark.createDataFrame([("a", 5.0, 1), ("b", 5.0, 1)], "customer_id string, total_order_amount double, num_orders int")
    assert [r["ltv_bucket"] for r in features.ltv_buckets(df).collect()] == [None, None]


def test_ratio_features_zero_orders(spark):
    df = spark.createDataFrame([("c1", 10.0, 0, 1.0, 2.0)],
                               "customer_id string, total_order_amount double, num_orders int, total_returns double, num_interactions double")
    r = features.customer_ratio_features(df).first()
    assert (r["avg_order_value"], r["return_rate"], r["interaction_per_order"]) == (0.0, 0.0, 0.0)


def test_histogram_covers_all_rows(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as x")
    h = explore.histogram(df, "x")
    assert h.agg({"count": "sum"}).first()[0] == 1000 and h.count() == 50
