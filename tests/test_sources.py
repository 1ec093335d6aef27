import datetime as dt

import pytest

from basketry import sources
from basketry.operators import clean


def test_csv_roundtrip_typed_dates(spark, tmp_path):
    df = spark.createDataFrame([
        ("1", "10", dt.datetime(2024, 1, 2), "2024-01-01,2024-01-02", "5"),
        ("2", "11", dt.datetime(2024, 1, 3), "2024-01-05", "x"),
    ], "order_id string, customer_id string, order_date timestamp, return_date string, num_items string")
    path = str(tmp_path / "orders_csv")
    sources.write_csv(df, path)
    back = {r["order_id"]: r for r in sources.read_orders(spark, path).collect()}
    assert back["1"]["order_date"] == dt.datetime(2024, 1, 2)
    # a multi-date cell stays unparsed; the list form keeps both dates
    assert back["1"]["return_date"] is None and len(back["1"]["return_dates"]) == 2
    assert back["2"]["return_date"] == dt.datetime(2024, 1, 5)
    assert clean.clean_orders(sources.read_orders(spark, path)).where("order_id = '2'").first()["num_items"] == 0.0


def test_read_inputs_with_schema(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "marketing_spend.csv").write_text(
        "campaign_id,channel,spend,impressions,clicks\n1,TV,12.50,100,7\n2,TV,bad,,3\n")
    df = sources.read_input(spark, "marketing_spend", str(d / "marketing_spend.csv"))
    rows = df.orderBy("campaign_id").collect()
    assert str(rows[0]["spend"]) == "12.50" and rows[1]["spend"] is None and rows[1]["impressions"] is None
    assert dict(df.dtypes)["clicks"] == "bigint"


def test_parquet_overwrite_and_publish(spark, tmp_path):
    path = str(tmp_path / "p")
    sources.write_parquet(spark.range(3), path)
    sources.write_parquet(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    sources.publish(spark.range(4).withColumnRenamed("id", "customer_id"), "basketry_test_mart",
                    path=str(tmp_path / "mart"))
    sources.publish(spark.range(6).withColumnRenamed("id", "customer_id"), "basketry_test_mart",
                    path=str(tmp_path / "mart"))
    assert "basketry_test_mart" in sources.list_tables(spark)
    assert sources.read_table(spark, "basketry_test_mart").count() == 6
    sources.drop_table(spark, "basketry_test_mart")
    assert "basketry_test_mart" not in sources.list_tables(spark)


def test_clean_and_publish(spark, small_inputs, tmp_path):
    from basketry.operators import summaries
    cs, os_ = clean.clean_and_publish(summaries.customer_summary(small_inputs),
                                      summaries.order_summary(small_inputs), str(tmp_path / "processed"))
    assert cs.where("gender IS NULL").count() == 0
    assert os_.count() == small_inputs["orders_fact"].count()


def test_publish_marts_idempotent(spark, small_inputs, tmp_path):
    from basketry.plans.publish import publish_marts
    for _ in range(2):
        names = publish_marts(spark, small_inputs, base_path=str(tmp_path / "wh"), prefix="t_", buckets=4)
    assert len(names) == 8
    n_customers = small_inputs["customers_dim"].count()
    assert spark.table("t_customer_rfm").count() == n_customers
    for n in names:
        sources.drop_table(spark, n)


def test_write_summaries_csv(spark, small_inputs, tmp_path):
    from basketry.plans.publish import write_summaries
    o, c = write_summaries(small_inputs, str(tmp_path / "data"))
    assert sources.read_orders(spark, o).count() == small_inputs["orders_fact"].count()
    assert sources.read_customers(spark, c).count() == small_inputs["customers_dim"].count()


def test_wide_mart_from_stored_marts(spark, small_inputs, tmp_path):
    """Joined bucket by bucket, equal to the mart computed from the inputs."""
    from basketry.operators import marts
    from basketry.plans.publish import features_from_marts, publish_marts
    names = publish_marts(spark, small_inputs, base_path=str(tmp_path / "wh"), prefix="w_", buckets=4)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = features_from_marts(spark, "w_")
        assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
        direct = marts.customer_features(small_inputs)
        assert wide.columns == direct.columns
        as_rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
        assert as_rows(wide) == as_rows(direct) == as_rows(spark.table("w_customer_features").select(*direct.columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    for n in [*names, "w_customer_base"]:
        sources.drop_table(spark, n)


def test_failed_publish_leaves_the_old_table(spark, tmp_path):
    from pyspark.sql import functions as F
    name, path = "basketry_swap", str(tmp_path / "swap")
    sources.publish(spark.range(4), name, path=path)
    reading = spark.table(name)
    bad = spark.range(10).withColumn("x", F.when(F.col("id") == 9, F.raise_error(F.lit("no"))).otherwise(F.lit("y")))
    with pytest.raises(Exception):
        sources.publish(bad, name, path=path)
    assert sources.read_table(spark, name).count() == 4 and name in sources.list_tables(spark)
    for n in (5, 6):
        sources.publish(spark.range(n), name, path=path)
        # whoever found the version before can still read it
        assert reading.count() == n - 1
        reading = spark.table(name)
    assert reading.count() == 6 and [t for t in sources.list_tables(spark) if t.startswith(name)] == [name]
    assert len(list((tmp_path / "swap").iterdir())) == 2        # the last two versions
    sources.drop_table(spark, name)
    assert not list((tmp_path / "swap").iterdir()) and name not in sources.list_tables(spark)
    # a table stored by other means is replaced
    spark.range(2).write.saveAsTable(name, path=str(tmp_path / "plain"))
    sources.publish(spark.range(7), name, path=path)
    assert spark.table(name).count() == 7
    sources.drop_table(spark, name)
