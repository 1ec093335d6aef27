"""Churn model M-01 .. M-13 (and X-09, X-10).

Labels and features are lazy aggregates; the time bounds are scalar subqueries
of the plan.  Training is a Spark ML ``Pipeline``; metrics are DataFrame
aggregates (exact AUC by a distributed running sum).
"""

from __future__ import annotations

import json
import math
import re

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import has, safe_div, whole_days_between
from basketry.operators.quantiles import range_count
from basketry.operators.scan import running_sums
from basketry.session import ensure_checkpoint_dir, materialise

LABEL = "churn_next_30d"
ONE_HOT = ["gender", "cohort", "acquisition_channel", "loyalty_status"]
DROP = ["signup_date", "return_reasons", "interaction_types", "interaction_texts", "channel"]
#: whole-history order totals of the customer summary; they cover the label
#: window, so they leak the label (D12) and are left out unless ``leaky``
LEAKY = ["num_orders", "total_order_amount", "total_discounts", "total_items",
         "unique_products", "total_quantity", "total_item_price", "total_returns"]
LEAVES = "leaves"
TRAIN_NUMERIC = ["train_num_orders", "train_total_sales", "train_avg_order_value",
                 "train_num_returns", "train_total_quantity", "recency_days"]


def label_bounds(orders: DataFrame, label_days: int = 30):
    """Cutoff (snapshot - ``label_days`` days) and snapshot (last order) as
    scalar subqueries: no job runs while the plan is built."""
    last = orders.agg(F.max(F.col("order_date").cast("timestamp_ntz")).alias("s"))
    gap = F.make_dt_interval(F.lit(label_days))
    return (last.select((F.col("s") - gap).cast("timestamp")).scalar(), last.select(F.col("s").cast("timestamp")).scalar())


def churn_labels(orders: DataFrame, label_days: int = 30, bounds=None) -> DataFrame:
    """M-01 (D11): 1 = churned, i.e. no order after the cutoff; one row per
    customer with an order, with the cutoff and snapshot as columns."""
    cutoff, snap = bounds or label_bounds(orders, label_days)
    last = (orders.where(F.col("customer_id").isNotNull())
            .groupBy(F.col("customer_id").cast("string").alias("customer_id"))
            .agg(F.max("order_date").alias("_last")))
    return last.select(
        "customer_id", F.when(F.col("_last") > cutoff, 0).otherwise(1).alias(LABEL),
        cutoff.alias("label_cutoff"), snap.alias("snapshot_date"))


def one_hot_levels(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null levels per column, for ``one_hot``.  The levels
    become columns of the plan, so they pass the driver; for columns of
    unknown width use ``churn_pipeline``, which encodes them sparsely."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                for c in cols]))
    rows = (df.select(pairs.alias("p")).select("p.c", "p.v").where(F.col("v").isNotNull())
            .distinct().orderBy("c", "v").collect())
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        levels[r["c"]].append(r["v"])
    return levels


def one_hot(df: DataFrame, cols: list[str], drop_first: bool = True,
            levels: dict[str, list[str]] | None = None) -> DataFrame:
    """M-04: 0/1 columns ``<col>_<level>`` per sorted level, the first level
    dropped; a null gives all zeros.  The encoded columns are removed."""
    cols = [c for c in cols if has(df, c)]
    levels = levels or one_hot_levels(df, cols)
    new = []
    for c in cols:
        for lv in levels[c][1 if drop_first else 0:]:
            new.append(F.when(F.col(c).cast("string") == lv, 1).otherwise(0).alias(f"{c}_{lv}"))
    keep = [F.col(x) for x in df.columns if x not in cols]
    return df.select(*keep, *new)


def churn_features(customers: DataFrame, orders: DataFrame, label_days: int = 30,
                   leaky: bool = False, bounds=None, levels=None, wide: bool = True) -> DataFrame:
    """M-02: features from orders up to the cutoff, joined to the customer
    summary; missing -> 0; returns per order; one-hot; ids and long text
    dropped.  ``leaky=True`` keeps the whole-history totals (D12);
    ``wide=False`` leaves the categories as they are, for ``churn_pipeline``
    to encode."""
    cutoff, _ = bounds or label_bounds(orders, label_days)
    train = orders.where(F.col("order_date") <= cutoff)
    agg = (train.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("train_num_orders"),
        F.sum(F.col("order_amount").cast("decimal(18,2)")).cast("double").alias("train_total_sales"),
        (F.sum(F.col("order_amount").cast("decimal(18,2)")).cast("double")
         / F.count("order_amount")).alias("train_avg_order_value"),
        F.sum(F.col("num_returns").cast("double")).alias("train_num_returns"),
        F.sum(F.col("total_quantity").cast("double")).alias("train_total_quantity"),
        whole_days_between(F.max(cutoff), F.max("order_date")).alias("recency_days"),
    ))
    feat = customers.join(agg, "customer_id", "left")
    feat = feat.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in TRAIN_NUMERIC})
    feat = feat.withColumn("returns_per_order", safe_div("train_num_returns", "train_num_orders"))
    if wide:
        feat = one_hot(feat, ONE_HOT, levels=levels)
    drop = DROP + ([] if leaky else LEAKY)
    feat = feat.drop(*[c for c in drop if has(feat, c)])
    return feat.withColumn("customer_id", F.col("customer_id").cast("string"))


def churn_training_set(customers: DataFrame, orders: DataFrame, label_days: int = 30,
                       leaky: bool = False, levels=None, wide: bool = True) -> DataFrame:
    """M-03: features with the label; a customer without any order counts as
    churned (label 1)."""
    bounds = label_bounds(orders, label_days)
    labels = churn_labels(orders, label_days, bounds).select("customer_id", LABEL)
    feat = churn_features(customers, orders, label_days, leaky, bounds, levels, wide)
    return (feat.join(labels, "customer_id", "left")
            .withColumn(LABEL, F.coalesce(F.col(LABEL), F.lit(1)).cast("int")))


def churn_split(data: DataFrame, validation: float = 0.2, seed: int = 42) -> DataFrame:
    """M-06: stratified split.  Within each label the ``validation`` share
    (rounded) with the smallest hash of (id, seed) is the validation part.

    The rank of a hash is exact without a global sort: rows are counted per
    label and hash range (the leading bits, as many ranges as a shuffle has
    partitions), the counts before each range come from those, and only rows of
    one range are ordered together."""
    bits = max(1, min(28, math.ceil(math.log2(range_count(data)))))
    h = F.md5(F.concat(F.col("customer_id"), F.lit(f":{seed}")))
    tagged = data.withColumn("_h", h).withColumn(
        "_r", F.shiftright(F.conv(F.substring("_h", 1, 7), 16, 10).cast("bigint"), 28 - bits))
    counts = tagged.groupBy(F.col(LABEL).alias("_l"), F.col("_r").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_l").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_l", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"),
                            F.sum("_n").over(Window.partitionBy("_l")).alias("_t"))
    inside = Window.partitionBy(LABEL, "_r").orderBy("_h", "customer_id")
    ranked = tagged.withColumn("_i", F.row_number().over(inside)).join(
        offsets, (F.col(LABEL) == F.col("_l")) & (F.col("_r") == F.col("_b")))
    return ranked.select(*data.columns, (F.col("_o") + F.col("_i") <= F.round(F.col("_t") * validation)).alias(
        "is_validation"))


def feature_columns(data: DataFrame) -> list[str]:
    skip = {"customer_id", LABEL, "is_validation", "age_group"}
    return [c for c, t in data.dtypes if c not in skip and t in ("double", "int", "bigint", "float")]


def churn_pipeline(data: DataFrame, rounds: int = 300, step: float = 0.05, depth: int = 6,
                   seed: int = 42, model: str = "gbt") -> Pipeline:
    """M-05 + M-07 / X-09: index ``age_group`` (alphabetical, unseen -> own
    code), one-hot the categories that are still text as sparse vectors (any
    number of levels, no column per level), assemble, then boosted trees or
    logistic regression.  To be fitted on training rows only (D14)."""
    stages, inputs = [], feature_columns(data)
    texts = [c for c in ONE_HOT if has(data, c)]
    if has(data, "age_group"):
        stages.append(StringIndexer(inputCol="age_group", outputCol="age_group_idx",
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        inputs = inputs + ["age_group_idx"]
    if texts:
        stages.append(StringIndexer(inputCols=texts, outputCols=[f"{c}_idx" for c in texts],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in texts], outputCols=[f"{c}_vec" for c in texts],
                                    handleInvalid="keep"))
        inputs = inputs + [f"{c}_vec" for c in texts]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    if model == "gbt":
        stages.append(GBTClassifier(labelCol=LABEL, featuresCol="features", stepSize=step,
                                    maxDepth=depth, maxIter=rounds, seed=seed, checkpointInterval=10, leafCol=LEAVES))
    elif model == "logreg":
        stages.append(LogisticRegression(labelCol=LABEL, featuresCol="features", maxIter=100))
    else:
        raise ValueError(f"model must be 'gbt' or 'logreg', not {model!r}")
    return Pipeline(stages=stages)


def best_round(gains: list[float], patience: int = 20) -> int:
    """Rounds to keep: the first best one before ``patience`` rounds without gain."""
    best = 0
    for k, gain in enumerate(gains):
        if gain > gains[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def _leaf_values(model: GBTClassificationModel) -> list[list[float]]:
    """What each leaf of each tree adds to the margin, leaves from left to
    right (at most rounds x 2^depth numbers, as the model itself)."""
    trees = re.split(r"Tree \d+ \(weight [^)]*\):", model.toDebugString)[1:]
    return [[w * float(v) for v in re.findall(r"Predict: (\S+)", text)] for w, text in zip(model.treeWeights, trees)]


def prefix_margins(model: GBTClassificationModel, rows: DataFrame, label: str = LABEL) -> DataFrame:
    """(round, label, margin) of every row after each round, from one pass: the
    model gives a row's leaf in every tree, and margins are running sums of the
    leaves' values."""
    leaves = vector_to_array(F.col(LEAVES))
    values = F.from_json(F.lit(json.dumps(_leaf_values(model))), "array<array<double>>")
    added = F.transform(leaves, lambda leaf, k: F.get(F.get(values, k), leaf.cast("int")))
    start = F.struct(F.array().cast("array<double>").alias("all"), F.lit(0.0).alias("last"))
    summed = F.aggregate(added, start, lambda s, x: F.struct(F.array_append(s["all"], s["last"] + x).alias("all"),
                                                             (s["last"] + x).alias("last")), lambda s: s["all"])
    return model.transform(rows).select(label, F.posexplode(summed).alias("k", "margin")).select(
        (F.col("k") + 1).alias("round"), label, "margin")


def prefix_auc(model: GBTClassificationModel, rows: DataFrame, label: str = LABEL) -> DataFrame:
    """(round, auc): exact AUC on ``rows`` after each round (ties count one half).
    Margins are counted per round and value before the running sums; a round
    without both labels has a null."""
    per = prefix_margins(model, rows, label).groupBy("round", "margin").agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    ranked = running_sums(per, "margin", ["neg"], group="round")
    wins = F.sum(F.col("pos").cast("decimal(38,0)") * (2 * F.col("neg_before") + F.col("neg")).cast("decimal(38,0)")).cast("double")
    return ranked.groupBy("round").agg(F.try_divide(wins, 2.0 * F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def _first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The ensemble's first ``n`` trees as a model of its own."""
    java, sc = model._java_obj, SparkContext.getOrCreate()
    jvm, gateway = sc._jvm, sc._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(jvm.double, n)
    for k in range(n):
        trees[k], weights[k] = java.trees()[k], java.treeWeights()[k]
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    cut.setFeaturesCol(java.getFeaturesCol())
    cut.setLeafCol(LEAVES)
    return GBTClassificationModel(cut)


def train_churn(data: DataFrame, rounds: int = 300, model: str = "gbt", patience: int = 20, **kw) -> PipelineModel:
    """M-11: fit on the training rows of ``churn_split``; the AUC of every prefix
    of the ensemble on the validation rows decides how many of at most ``rounds``
    trees stay (``patience`` rounds without gain end the search; where validation
    rows have one label only, all stay).

    A round does not depend on later ones, so the search first fits few rounds
    and, if it does not end inside those, all of them: an ensemble is fitted
    twice at most, and the model is the one that fitting all rounds at once
    would give."""
    # boosting keeps a growing lineage of per-round predictions; with a
    # checkpoint folder Spark ML cuts it every ``checkpointInterval`` rounds
    ensure_checkpoint_dir(data.sparkSession)
    data = materialise(data, "training")
    train, held = data.where(~F.col("is_validation")), data.where(F.col("is_validation"))
    if model != "gbt" or held.select(LABEL).distinct().count() < 2:
        return churn_pipeline(data, rounds=rounds, model=model, **kw).fit(train)
    n = min(rounds, 2 * patience + 10)
    while True:
        *prepare, trees = churn_pipeline(data, rounds=n, **kw).fit(train).stages
        curve = {r["round"]: r["auc"] for r in prefix_auc(trees, PipelineModel(prepare).transform(held)).collect()}
        keep = best_round([curve[k] for k in sorted(curve)], patience)
        if n == rounds or n - keep >= patience:
            return PipelineModel([*prepare, _first_trees(trees, keep)])
        n = rounds


def auc_curve(model: PipelineModel, data: DataFrame) -> DataFrame:
    """(round, auc) of a boosted model on the validation rows, after each kept round."""
    *prepare, trees = model.stages
    return prefix_auc(trees, PipelineModel(prepare).transform(data.where(F.col("is_validation"))))


def churn_scores(model: PipelineModel, data: DataFrame) -> DataFrame:
    """M-13: churn probability and 0/1 prediction (p > 0.5) for every row."""
    scored = model.transform(data)
    p = vector_to_array("probability")[1]
    return scored.select("customer_id", *[c for c in (LABEL, "is_validation") if has(data, c)],
                         p.alias("score"), (p > 0.5).cast("int").alias("prediction"))


def churn_probability(model: PipelineModel, data: DataFrame, customer_id: str) -> float | None:
    """M-13, the reference's single-customer call: the probability for one
    customer (one row reaches the driver)."""
    row = churn_scores(model, data.where(F.col("customer_id") == customer_id)).first()
    return None if row is None else float(row["score"])


def churn_metrics(scores: DataFrame) -> dict[str, DataFrame]:
    """M-08 .. M-10 on validation scores: AUC, confusion matrix, report."""
    if has(scores, "is_validation"):
        scores = scores.where(F.col("is_validation"))
    return {"auc": auc(scores), "confusion_matrix": confusion_matrix(scores),
            "classification_report": classification_report(scores)}


def training_metrics(scores: DataFrame, curve: DataFrame | None = None) -> DataFrame:
    """M-11: the metrics of a training run as one table (metric, class, value);
    ``curve`` (round, auc) adds the AUC after each round (its number as class)."""
    got = churn_metrics(scores)
    line = lambda metric, cls, v: F.struct(F.lit(metric).alias("metric"), cls.cast("string").alias("class"),
                                           v.cast("double").alias("value"))
    none = F.lit(None)
    parts = [got["auc"].select(line("auc", none, F.col("auc")).alias("m"))]
    cell = F.concat_ws("/", F.col(LABEL), F.col("prediction"))
    parts.append(got["confusion_matrix"].select(line("count", cell, F.col("count")).alias("m")))
    for c in ("precision", "recall", "f1_score", "support"):
        parts.append(got["classification_report"].select(line(c, F.col("class"), F.col(c)).alias("m")))
    if curve is not None:
        parts.append(curve.select(line("auc_after_round", F.col("round"), F.col("auc")).alias("m")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("m.*")


def save_model(model: PipelineModel, path: str) -> None:
    """M-12."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """M-12."""
    return PipelineModel.load(path)


def rule_scores(data: DataFrame, days: float = 730.0) -> DataFrame:
    """A fixed score for checking the metrics: recency over ``days``, capped
    at 1; prediction p > 0.5."""
    s = F.least(F.col("recency_days").cast("double") / F.lit(days), F.lit(1.0))
    return data.select("customer_id", F.col(LABEL), s.alias("score"),
                       (s > 0.5).cast("int").alias("prediction"))


def auc(scores: DataFrame, label: str = LABEL, score: str = "score") -> DataFrame:
    """M-08: exact area under the ROC curve (ties count one half), one row.

    Scores are counted per distinct value (written once: the running sum
    reads them several times); the negatives below each value come from a
    distributed running sum, so no task sees all scores."""
    per = scores.groupBy(F.col(score).alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("bigint").alias("neg"))
    ranked = running_sums(per, "s", ["neg"])
    num = F.sum(F.col("pos").cast("decimal(38,0)") * (F.lit(2) * F.col("neg_before") + F.col("neg"))
                .cast("decimal(38,0)"))
    return ranked.agg(
        (num.cast("double") / (F.lit(2.0) * F.sum("pos").cast("double") * F.sum("neg").cast("double")))
        .alias("auc"))


def confusion_matrix(scores: DataFrame, label: str = LABEL, pred: str = "prediction") -> DataFrame:
    """M-09: the four cells (label, prediction, count), zeros included."""
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    row = scores.agg(*[F.count_if((F.col(label) == a) & (F.col(pred) == b)).alias(f"c{a}{b}")
                       for a, b in cells])
    stack = F.explode(F.array(*[F.struct(F.lit(a).alias(label), F.lit(b).alias(pred),
                                         F.col(f"c{a}{b}").alias("count")) for a, b in cells]))
    return row.select(stack.alias("x")).select("x.*")


def classification_report(scores: DataFrame, label: str = LABEL, pred: str = "prediction") -> DataFrame:
    """M-10: precision, recall, F1 and support per class, accuracy, macro and
    weighted averages (0 where a ratio is undefined), rounded to 9 decimals."""
    cm = scores.agg(*[F.count_if((F.col(label) == a) & (F.col(pred) == b)).cast("double").alias(f"c{a}{b}")
                      for a in (0, 1) for b in (0, 1)])
    c = F.col

    def ratio(n, d):
        return F.coalesce(F.try_divide(n, d), F.lit(0.0))

    p0, r0 = ratio(c("c00"), c("c00") + c("c10")), ratio(c("c00"), c("c00") + c("c01"))
    p1, r1 = ratio(c("c11"), c("c11") + c("c01")), ratio(c("c11"), c("c11") + c("c10"))
    s0, s1 = c("c00") + c("c01"), c("c10") + c("c11")
    wide = cm.select(p0.alias("p0"), r0.alias("r0"), p1.alias("p1"), r1.alias("r1"),
                     s0.alias("s0"), s1.alias("s1"), (c("c00") + c("c11")).alias("ok"))
    f0 = ratio(2 * c("p0") * c("r0"), c("p0") + c("r0"))
    f1 = ratio(2 * c("p1") * c("r1"), c("p1") + c("r1"))
    wide = wide.withColumns({"f0": f0, "f1": f1})
    n = c("s0") + c("s1")

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), F.round(p, 9).alias("precision"),
                        F.round(r, 9).alias("recall"), F.round(f, 9).alias("f1_score"),
                        s.cast("bigint").alias("support"))

    rows = F.array(
        row("0", c("p0"), c("r0"), c("f0"), c("s0")),
        row("1", c("p1"), c("r1"), c("f1"), c("s1")),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), ratio(c("ok"), n), n),
        row("macro avg", (c("p0") + c("p1")) / 2, (c("r0") + c("r1")) / 2, (c("f0") + c("f1")) / 2, n),
        row("weighted avg", ratio(c("p0") * c("s0") + c("p1") * c("s1"), n),
            ratio(c("r0") * c("s0") + c("r1") * c("s1"), n),
            ratio(c("f0") * c("s0") + c("f1") * c("s1"), n), n))
    return wide.select(F.explode(rows).alias("x")).select("x.*")


def churn_risk_bands(scores: DataFrame, segments: DataFrame, segment: str = "acquisition_channel",
                     cuts=(0.33, 0.66), score: str = "score") -> DataFrame:
    """X-10: scores banded low / mid / high and counted per segment (a share of
    churners only if ``score`` is a calibrated probability)."""
    s = F.col(score)
    band = F.when(s < cuts[0], "low").when(s < cuts[1], "mid").otherwise("high")
    return (scores.join(segments.select("customer_id", segment), "customer_id", "left")
            .groupBy(segment, band.alias("risk_band"))
            .agg(F.count(F.lit(1)).alias("customers"), F.avg(score).alias("mean_score")))
