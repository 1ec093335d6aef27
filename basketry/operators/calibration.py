"""X-10: scores as probabilities.

A score that ranks well need not be a probability.  Isotonic regression on
validation rows maps it to the observed churn rate without changing the order;
a reliability table and the Brier score tell how far score and rate are apart.
"""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.churn import LABEL

#: scores are rounded to so many decimals before the fit, which bounds the model
DECIMALS = 4


def fit_calibration(scores: DataFrame, label: str = LABEL, score: str = "score") -> IsotonicRegressionModel:
    """Isotonic regression of the label on the score.  Rows are first counted
    per rounded score, so the fit sees at most 10^``DECIMALS`` + 1 of them
    whatever the table's size; null scores and labels are left out."""
    known = scores.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    per = known.groupBy(F.round(score, DECIMALS).alias("score")).agg(
        F.avg(F.col(label).cast("double")).alias("rate"), F.count(F.lit(1)).cast("double").alias("n"))
    return IsotonicRegression(featuresCol="score", labelCol="rate", weightCol="n", predictionCol="calibrated").fit(per)


def calibrated(model: IsotonicRegressionModel, scores: DataFrame, score: str = "score") -> DataFrame:
    """``scores`` with the column ``calibrated`` (linear between fitted scores)."""
    rounded = scores.withColumn("_rounded", F.round(score, DECIMALS))
    known = model.setFeaturesCol("_rounded").transform(rounded.where(F.col("_rounded").isNotNull()))
    unknown = rounded.where(F.col("_rounded").isNull()).withColumn("calibrated", F.lit(None).cast("double"))
    return known.unionByName(unknown).drop("_rounded")


def reliability(rows: DataFrame, label: str = LABEL, score: str = "score", bins: int = 10) -> DataFrame:
    """Per bin of equal width of the score (and bin -1 for all): customers,
    mean_score, mean_calibrated, observed rate, and the Brier score (mean
    squared distance from the label) before and after, 9 decimals."""
    y, s, c = F.col(label).cast("double"), F.col(score), F.col("calibrated")
    own = F.greatest(F.lit(0), F.least(F.floor(s * bins), F.lit(bins - 1))).cast("int")
    both = rows.where(s.isNotNull() & y.isNotNull()).select(y.alias("y"), s.alias("s"), c.alias("c"),
                                                             F.explode(F.array(own, F.lit(-1))).alias("bin"))
    y, s, c = F.col("y"), F.col("s"), F.col("c")
    means = {"mean_score": s, "mean_calibrated": c, "observed": y, "brier": (s - y) * (s - y), "brier_calibrated": (c - y) * (c - y)}
    return both.groupBy("bin").agg(F.count(F.lit(1)).alias("customers"), *[F.round(F.avg(v), 9).alias(k) for k, v in means.items()])


def churn_calibration(scores: DataFrame) -> DataFrame:
    """Reliability of the validation rows' scores (all rows without a split),
    calibrated on themselves."""
    held = scores.where(F.col("is_validation")) if "is_validation" in scores.columns else scores
    return reliability(calibrated(fit_calibration(held), held))
