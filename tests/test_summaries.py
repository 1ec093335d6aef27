from basketry import schemas
from basketry.operators import fills, summaries


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    assert [tuple(r) for r in fills.modes(df, ["v"]).collect()] == [("v", "a")]
    assert [r[0] for r in fills.mode_fill(df, ["v"]).collect()] == ["b", "a", "b", "a", "a"]


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert fills.medians(df, ["x"]) == {"x": 2.5}
    assert fills.median_fill(df, ["x"]).collect()[-1][0] == 2.5


def test_weighted_statistics_match_repeated_rows(spark):
    rows = [("a", 1.0, "x", 3), ("b", 4.0, "y", 2), ("c", 9.0, "x", 1), ("d", None, None, 5)]
    df = spark.createDataFrame(rows, "k string, n double, t string, _w long")
    long = spark.createDataFrame([r[:3] for r in rows for _ in range(r[3])], "k string, n double, t string")
    assert fills.weighted_medians(fills.stacked(df, ["n"], "double", "_w")) == fills.medians(long, ["n"])
    pairs = fills.stacked(df, ["t"], "string", "_w")
    assert fills.mode_table(pairs).collect() == fills.modes(long, ["t"]).collect()


def test_fill_values_of_narrow_sides_equal_those_of_the_wide_table(spark, small_inputs):
    raw = summaries.order_summary(small_inputs, fill="none")
    numeric = ["num_returns", "num_interactions", "total_spend"]
    texts = ["return_reasons", "interaction_texts", "channel"]
    want = fills.mode_fill(fills.median_fill(raw, numeric), texts)
    got = summaries.order_summary(small_inputs)
    cols = ["order_id", *numeric, *texts]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_columns_limit_the_sides(spark, small_inputs):
    full = summaries.customer_summary(small_inputs)
    few = summaries.customer_summary(small_inputs, columns=["customer_id", "num_orders", "channel"])
    assert few.columns == ["customer_id", "num_orders", "channel"]
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, full.select(*few.columns).collect()))


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert {r["column"]: r["nulls"] for r in fills.null_profile(df).collect()} == {"a": 1, "b": 2}


def test_order_summary_one_row_per_order(spark, small_inputs):
    raw = summaries.order_summary(small_inputs, fill="none")
    filled = summaries.order_summary(small_inputs)
    n_orders = small_inputs["orders_fact"].count()
    assert raw.count() == n_orders == filled.count()
    assert raw.select("order_id").distinct().count() == n_orders
    # every order looks returned after the reference's fill (D8)
    assert filled.where("num_returns IS NULL").count() == 0


def test_customer_summary_one_row_per_customer(spark, small_inputs):
    cs = summaries.customer_summary(small_inputs)
    assert cs.count() == small_inputs["customers_dim"].count()
    nulls = {r["column"]: r["nulls"] for r in fills.null_profile(cs).collect()}
    for c in schemas.CUSTOMER_NUMERIC_FILL + schemas.CUSTOMER_MODE_FILL:
        assert nulls[c] == 0, c


def test_items_per_customer_counts_distinct_products(spark):
    items = spark.createDataFrame([("i1", "o1", "p1", 1, 1), ("i2", "o1", "p1", 2, 1), ("i3", "o2", "p2", 1, 1),
                                   ("i4", "o9", "p3", 1, 1)],
                                  "order_item_id string, order_id string, product_id string, quantity bigint, price int")
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c1")], "order_id string, customer_id string")
    r = summaries.items_per_customer(items, orders).collect()
    assert len(r) == 1
    assert (r[0]["total_items"], r[0]["unique_products"], r[0]["total_quantity"]) == (3, 2, 4)


def test_items_per_order_gathers_each_product_once(spark):
    items = spark.createDataFrame(
        [("1", "o1", "p2", 1, 1.5), ("2", "o1", "p1", 2, 2.5), ("3", "o1", "p2", 3, 3.5), ("4", "o2", None, None, None),
         ("5", "o3", "gone", 1, 1.0), ("6", "o3", "p3", 1, 1.0), ("7", "o3", "p1", 1, 1.0), ("8", None, "p1", 1, 1.0)],
        "order_item_id string, order_id string, product_id string, quantity long, price double").repartition(3)
    products = spark.createDataFrame([("p1", "b", "x"), ("p2", "a", "x"), ("p3", None, "y"), ("p4", "c", "z")],
                                     "product_id string, category string, subcategory string")
    out = summaries.items_per_order(items, products)
    assert sorted(map(tuple, out.collect())) == [
        ("o1", 3, "p1,p2", 6, 7.5, "a,b", "x"), ("o2", 1, "", 0, 0.0, "", ""), ("o3", 3, "gone,p1,p3", 3, 3.0, "b", "x,y")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("collect_set(") == 1
