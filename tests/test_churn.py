import datetime as dt
import random

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from basketry.operators import churn

SNAP = dt.datetime(2024, 6, 30)


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, order_date timestamp, "
                                       "order_amount double, num_returns double, total_quantity double")


def test_label_window(spark):
    cutoff = SNAP - dt.timedelta(days=30)
    o = _orders(spark, [("1", "a", SNAP, 1.0, 0.0, 1.0), ("2", "b", cutoff, 1.0, 0.0, 1.0),
                        ("3", "c", cutoff + dt.timedelta(seconds=1), 1.0, 0.0, 1.0)])
    got = {r["customer_id"]: r["churn_next_30d"] for r in churn.churn_labels(o).collect()}
    assert got == {"a": 0, "b": 1, "c": 0}


def test_unknown_customer_is_churned_and_recency(spark):
    cutoff = SNAP - dt.timedelta(days=30)
    o = _orders(spark, [("1", "a", SNAP, 10.0, 1.0, 2.0), ("2", "a", cutoff - dt.timedelta(days=10, hours=12), 4.0, 0.0, 1.0)])
    cust = spark.createDataFrame([("a", "F"), ("z", None)], "customer_id string, gender string")
    ts = {r["customer_id"]: r for r in churn.churn_training_set(cust, o).collect()}
    assert ts["z"]["churn_next_30d"] == 1 and ts["z"]["recency_days"] == 0.0
    assert ts["a"]["churn_next_30d"] == 0 and ts["a"]["recency_days"] == 10.0
    assert ts["a"]["train_num_orders"] == 1.0 and ts["a"]["train_total_sales"] == 4.0


def test_one_hot_null_all_zero(spark):
    df = spark.createDataFrame([("1", "F"), ("2", None), ("3", "M"), ("4", "F")], "id string, gender string")
    out = churn.one_hot(df, ["gender"]).orderBy("id")
    assert out.columns == ["id", "gender_M"]
    assert [r["gender_M"] for r in out.collect()] == [0, 0, 1, 0]


def test_auc_matches_evaluator(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 20))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "churn_next_30d int, score double")
    ours = churn.auc(df).first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="churn_next_30d", numBins=0)
    ref = ev.evaluate(df.withColumn("churn_next_30d", F.col("churn_next_30d").cast("double")))
    assert abs(ours - ref) < 1e-12


def test_split_stable_across_partitions(spark):
    df = spark.range(5000).selectExpr("cast(id as string) as customer_id", "int(id % 7 = 0) as churn_next_30d")
    a = {r[0] for r in churn.churn_split(df.repartition(3)).where("is_validation").collect()}
    b = {r[0] for r in churn.churn_split(df.repartition(11)).where("is_validation").collect()}
    assert a == b
    # exactly a fifth of each label
    assert len([i for i in a if int(i) % 7 == 0]) == round(0.2 * 715)
    assert len([i for i in a if int(i) % 7]) == round(0.2 * 4285)


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "churn_next_30d int, prediction int")
    cm = {(r[0], r[1]): r[2] for r in churn.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 1}
    rep = {r["class"]: r for r in churn.classification_report(df).collect()}
    assert rep["1"]["precision"] == 0.5 and rep["0"]["recall"] == round(2 / 3, 9)
    assert rep["accuracy"]["f1_score"] == 0.6 and rep["weighted avg"]["support"] == 5


def test_train_save_load_score(spark, tmp_path):
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        rec = rnd.uniform(0, 400)
        rows.append((str(i), rec, rnd.uniform(0, 5), "18-25" if i % 2 else "26-35",
                     1 if rec + rnd.gauss(0, 60) > 200 else 0))
    data = churn.churn_split(spark.createDataFrame(
        rows, "customer_id string, recency_days double, train_num_orders double, age_group string, churn_next_30d int"))
    model = churn.train_churn(data, rounds=10)
    path = str(tmp_path / "churn_model")
    churn.save_model(model, path)
    again = churn.load_model(path)
    a = churn.churn_scores(model, data).orderBy("customer_id").collect()
    b = churn.churn_scores(again, data).orderBy("customer_id").collect()
    assert [r["score"] for r in a] == [r["score"] for r in b]
    assert churn.auc(churn.churn_scores(model, data)).first()["auc"] > 0.8


def _hard(spark, n=1500):
    rnd = random.Random(12)
    rows = []
    for i in range(n):
        rec, orders, size = rnd.uniform(0, 400), rnd.uniform(0, 8), rnd.uniform(0, 50)
        wave = 60 * ((rec // 50) % 2) + 25 * (orders > 3) * (size < 20) - 0.1 * rec
        rows.append((str(i), rec, orders, size, "18-25" if i % 2 else "26-35", f"cohort{rnd.randint(0, 30)}",
                     1 if wave + rnd.gauss(0, 30) > 12 else 0))
    return churn.churn_split(spark.createDataFrame(
        rows, "customer_id string, recency_days double, train_num_orders double, total_spend double, age_group string, "
              "cohort string, churn_next_30d int"))


def test_boosting_keeps_many_trees_and_beats_one(spark):
    data = _hard(spark)
    model = churn.train_churn(data, rounds=60, depth=3, patience=20)
    trees = model.stages[-1]
    assert trees.getNumTrees > 20
    held = data.where("is_validation")

    def auc(m):
        return churn.auc(churn.churn_scores(m, held)).first()["auc"]

    from pyspark.ml import PipelineModel
    one = PipelineModel([*model.stages[:-1], churn._first_trees(trees, 1)])
    assert auc(model) > auc(one) + 0.02
    # the curve is the AUC of each prefix as a model of its own, and no kept prefix is better
    curve = {r["round"]: r["auc"] for r in churn.auc_curve(model, data).collect()}
    assert sorted(curve) == list(range(1, trees.getNumTrees + 1))
    for k in (1, 2, 9, trees.getNumTrees):
        assert abs(curve[k] - auc(PipelineModel([*model.stages[:-1], churn._first_trees(trees, k)]))) < 1e-12
    assert max(curve.values()) == curve[trees.getNumTrees] > max(v for k, v in curve.items() if k < trees.getNumTrees)
    # margins rebuilt from the leaves are the model's
    ready = PipelineModel(model.stages[:-1]).transform(held)
    margins = sorted(r["margin"] for r in churn.prefix_margins(trees, ready).where(F.col("round") == trees.getNumTrees).collect())
    from pyspark.ml.functions import vector_to_array
    raw = sorted(r["r"] / 2 for r in trees.transform(ready).select((vector_to_array("rawPrediction")[1] * 2).alias("r")).collect())
    assert np.allclose(margins, raw, atol=1e-12)
    metrics = {(r["metric"], r["class"]): r["value"] for r in churn.training_metrics(churn.churn_scores(model, data)).collect()}
    assert abs(metrics["auc", None] - auc(model)) < 1e-12
    assert sum(v for (m, _), v in metrics.items() if m == "count") == held.count()


def test_one_label_in_validation_keeps_all_rounds(spark):
    data = _hard(spark, 200).withColumn("is_validation", F.col("is_validation") & (F.col(churn.LABEL) == 1))
    assert churn.train_churn(data, rounds=3, depth=2).stages[-1].getNumTrees == 3


def test_best_round_waits_with_patience():
    assert churn.best_round([-5, -4, -4.1, -4.2, -3, -3.5], patience=20) == 5
    assert churn.best_round([-5, -4, -4.1, -4.2, -3, -3.5], patience=2) == 2
    assert churn.best_round([1.0]) == 1
    assert churn.best_round([0.7, 0.8, 0.8, 0.8], patience=20) == 2     # the first of equals


def test_indexer_sees_training_rows_only(spark):
    data = _hard(spark, 200).withColumn(
        "age_group", F.when(F.col("is_validation"), F.lit("seen in validation")).otherwise(F.col("age_group")))
    model = churn.train_churn(data, model="logreg")
    assert "seen in validation" not in model.stages[0].labels


def test_fifty_thousand_levels_train(spark):
    data = spark.range(50_000).selectExpr(
        "cast(id as string) as customer_id", "concat('c', id) as cohort", "double(id % 100) as recency_days",
        "int(id % 100 > 60) as churn_next_30d")
    model = churn.train_churn(churn.churn_split(data), model="logreg")
    assert churn.churn_scores(model, data.withColumn("is_validation", F.lit(True)).limit(10)).count() == 10


def test_search_fits_an_ensemble_twice_at_most(spark, monkeypatch):
    data = _hard(spark, 200)
    fitted, pipeline = [], churn.churn_pipeline
    monkeypatch.setattr(churn, "churn_pipeline", lambda data, rounds, **kw: fitted.append(rounds) or pipeline(data, rounds=rounds, **kw))
    # a curve that rises to the last round
    monkeypatch.setattr(churn, "prefix_auc", lambda model, rows: rows.sparkSession.range(1, model.getNumTrees + 1).selectExpr(
        "id AS round", "id / 100.0D AS auc"))
    model = churn.train_churn(data, rounds=40, depth=1, patience=1)
    assert fitted == [12, 40] and model.stages[-1].getNumTrees == 40


def test_risk_bands_read_the_shop_once(spark, monkeypatch):
    from basketry.plans.queries import REGISTRY
    train = churn.train_churn
    monkeypatch.setattr(churn, "train_churn", lambda data: train(data, rounds=2, depth=2))
    read = {f.rsplit("/", 1)[-1] if ".parquet/" not in f else f.split(".parquet/")[0].rsplit("/", 1)[-1] + ".parquet"
            for f in REGISTRY["churn_risk_bands"](spark, "/root/testdata/sf0.001").inputFiles()}
    assert "customer.parquet" in read and not read & {"orders.parquet", "lineitem.parquet", "events.parquet", "supplier.parquet"}
