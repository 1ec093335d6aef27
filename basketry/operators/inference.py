"""X-04: effects of an action on an outcome beyond one stratum column.

``causal_effect`` is doubly robust: a logistic model of who is treated and a
linear model of the outcome in each group give every row one influence value,
whose mean is right if either model is.  Its spread comes from a Poisson
bootstrap: a row's weight in a replicate is a Poisson(1) number read from a hash
of its id, so replicates need no random state, every one is computed in the
same pass, and a re-run gives the same ones.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.special import normal_two_sided
from basketry.operators.quantiles import column_quantiles
from basketry.session import materialise

#: Poisson(1) distribution function up to where a 32-bit hash can tell values apart
POISSON = [math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) for k in range(12)]


def poisson_weight(row_id: Column, replicate: Column, seed: int = 42) -> Column:
    """Poisson(1) weight of a row in a replicate, from md5(id:seed:replicate)."""
    key = F.concat_ws(":", row_id.cast("string"), F.lit(str(seed)), replicate.cast("string"))
    u = (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 32)
    weight = F.lit(0)
    for cut in POISSON:
        weight = weight + F.when(u >= cut, 1).otherwise(0)
    return weight


def replicate_means(rows: DataFrame, row_id: str, values: dict[str, Column], replicates: int = 200, seed: int = 42) -> DataFrame:
    """One row per replicate (from 1): weighted mean of each of ``values`` over
    its non-null rows.  Each row stands in all replicates of the same pass and is
    summed before the shuffle, so a task sends one row per replicate."""
    own = rows.select(F.col(row_id).alias("_id"), *[v.cast("double").alias(k) for k, v in values.items()])
    drawn = own.select("*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")).withColumn(
        "_w", poisson_weight(F.col("_id"), F.col("replicate"), seed))
    return drawn.groupBy("replicate").agg(*[
        F.try_divide(F.sum(F.col("_w") * F.col(k)), F.sum(F.when(F.col(k).isNotNull(), F.col("_w")))).alias(k) for k in values])


def bootstrap_difference(rows: DataFrame, row_id: str, outcome: str, treated: Column, replicates: int = 100,
                         seed: int = 42) -> DataFrame:
    """Per replicate: the difference of mean ``outcome`` (treated - control), 6 decimals."""
    y = F.col(outcome).cast("double")
    means = replicate_means(rows, row_id, {"a": F.when(treated, y), "b": F.when(~treated, y)}, replicates, seed)
    return means.select("replicate", F.round(F.col("a"), 6).alias("mean_treated"), F.round(F.col("b"), 6).alias("mean_control"),
                        F.round(F.col("a") - F.col("b"), 6).alias("effect"))


def influence(rows: DataFrame, row_id: str, outcome: str, treated: Column, categories: list[str],
              numbers: list[str] | None = None, least: float = 0.01) -> DataFrame:
    """Per row (id, t, y, propensity, influence) of the doubly robust estimate.

    Rows without an outcome or with an unknown treatment are left out; a null
    category counts as the empty one, a null number counts as 0.  Propensities
    are held inside [``least``, 1 - ``least``]."""
    numbers = numbers or []
    data = materialise(rows.select(
        F.col(row_id).cast("string").alias("_id"), F.col(outcome).cast("double").alias("y"), treated.cast("int").alias("t"),
        *[F.concat(F.lit("="), F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in categories],
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numbers],
    ).where(F.col("y").isNotNull() & F.col("t").isNotNull()), "causal")
    stages, inputs = [], list(numbers)
    if categories:
        stages = [StringIndexer(inputCols=categories, outputCols=[f"{c}_i" for c in categories], stringOrderType="alphabetAsc"),
                  OneHotEncoder(inputCols=[f"{c}_i" for c in categories], outputCols=[f"{c}_v" for c in categories])]
        inputs += [f"{c}_v" for c in categories]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    ready = Pipeline(stages=stages).fit(data).transform(data)
    who = LogisticRegression(featuresCol="features", labelCol="t", probabilityCol="p", rawPredictionCol="raw",
                             predictionCol="guess", maxIter=200, tol=1e-10).fit(ready)
    scored = who.transform(ready).drop("raw", "guess")
    for level, name in ((1, "m1"), (0, "m0")):
        model = LinearRegression(featuresCol="features", labelCol="y", predictionCol=name, solver="normal").fit(
            ready.where(F.col("t") == level))
        scored = model.transform(scored)
    e = F.greatest(F.lit(least), F.least(F.lit(1 - least), vector_to_array("p")[1]))
    value = (F.col("m1") - F.col("m0") + F.col("t") * (F.col("y") - F.col("m1")) / e
             - (1 - F.col("t")) * (F.col("y") - F.col("m0")) / (1 - e))
    return scored.select("_id", "t", "y", e.alias("propensity"), value.alias("influence"))


def causal_effect(rows: DataFrame, row_id: str, outcome: str, treated: Column, categories: list[str],
                  numbers: list[str] | None = None, replicates: int = 200, level: float = 0.95, seed: int = 42) -> DataFrame:
    """One row: n, n_treated, naive_difference, effect (doubly robust average
    effect of treatment), std_error, low and high (percentiles of the
    bootstrap), p_value (normal, two-sided).  Without both groups: counts and
    nulls."""
    t = treated.cast("int")
    sizes = rows.where(F.col(outcome).isNotNull()).agg(F.count(t).alias("n"), F.coalesce(F.sum(t), F.lit(0)).alias("k")).first()
    schema = ("n bigint, n_treated bigint, naive_difference double, effect double, std_error double, low double, high double, "
              "p_value double")
    spark = rows.sparkSession
    if not 0 < sizes["k"] < sizes["n"]:
        return spark.createDataFrame([(sizes["n"], sizes["k"], *[None] * 6)], schema)
    found = materialise(influence(rows, row_id, outcome, treated, categories, numbers), "influence")
    bounds = column_quantiles(replicate_means(found, "_id", {"v": F.col("influence")}, replicates, seed), ["v"],
                              [(1 - level) / 2, (1 + level) / 2])["v"]
    on = F.col("t") == 1
    effect, error = F.avg("influence"), F.stddev_samp("influence") / F.sqrt(F.count("influence"))
    out = found.agg(F.count("t").alias("n"), F.sum("t").cast("bigint").alias("n_treated"),
                    (F.avg(F.when(on, F.col("y"))) - F.avg(F.when(~on, F.col("y")))).alias("naive_difference"),
                    effect.alias("effect"), error.alias("std_error"))
    return out.select("*", F.lit(bounds[0]).alias("low"), F.lit(bounds[1]).alias("high"),
                      normal_two_sided(F.try_divide(F.col("effect"), F.col("std_error"))).alias("p_value"))
