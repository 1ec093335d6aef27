"""Exact quantiles without one unbounded buffer.

Values are counted per distinct value (a shuffle with partial sums; a weight
counts a value several times) and written once.  Each group's values are cut
into ranges at the quantiles of a mergeable KLL sketch, and a value finds its
range by binary search; the range totals say in which range each wanted rank
lies, and only those ranges are ordered, each by its own window task.  Results equal the linear-interpolation quantile (pandas' default, SQL
``quantile_cont``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import materialise


def range_count(df: DataFrame) -> int:
    """Ranges to cut a table into: as many as a shuffle has partitions."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def sketched_cuts(value: str, ranges: int) -> Column:
    """Aggregate: the cuts between ``ranges`` ranges of ``value``, from a KLL
    sketch whose size (and rank error, about 2 / size) follows the ranges; null
    without values.  Cuts may repeat."""
    size = min(max(200, 8 * ranges), 65_535)
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size))
    ranks = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


def range_of(value: Column, cuts: Column) -> Column:
    """How many of the sorted ``cuts`` are below ``value``, by binary search."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + F.lit(1.0))).cast("int") + 1)
    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))

    def halve(s, _):
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = (s["low"] < s["high"]) & (F.get(cuts, middle) < value)
        return F.struct(F.when(below, middle + 1).otherwise(s["low"]).alias("low"),
                        F.when(below | (s["low"] >= s["high"]), s["high"]).otherwise(middle).alias("high"))

    return F.aggregate(steps, start, halve, lambda s: s["low"])


def grouped_quantiles(pairs: DataFrame, qs: list[float], ranges: int | None = None) -> dict:
    """``pairs`` has columns ``g`` (group key, as few values as a caller asks
    statistics for), ``v`` (number) and optionally ``w`` (how often it counts).
    Returns {g: [quantile per q]} over the non-null ``v`` of each group."""
    weight = F.col("w") if "w" in pairs.columns else F.lit(1)
    counted = materialise(
        pairs.where(F.col("v").isNotNull()).groupBy("g", F.col("v").cast("double").alias("v"))
        .agg(F.sum(weight.cast("bigint")).alias("c")).where(F.col("c") > 0), "value-counts")
    k = ranges or range_count(pairs)
    meta = {r["g"]: r for r in counted.groupBy("g").agg(F.sum("c").alias("n"), sketched_cuts("v", k).alias("cuts")).collect()}
    if not meta:
        return {}
    spark = counted.sparkSession
    kind = f"g {dict(counted.dtypes)['g']}"
    # one row per group asked for, each with fewer cuts than ranges
    edges = spark.createDataFrame([(g, sorted(set(r["cuts"]))) for g, r in meta.items()], f"{kind}, cuts array<double>")
    tagged = counted.join(edges, "g").withColumn("b", range_of(F.col("v"), F.col("cuts"))).drop("cuts")
    totals: dict = {}
    for r in tagged.groupBy("g", "b").agg(F.sum("c").alias("t")).orderBy("g", "b").collect():
        totals.setdefault(r["g"], []).append((r["b"], r["t"]))
    wanted, asked = set(), {}
    for g, r in meta.items():
        asked[g] = [(q * (r["n"] - 1), math.floor(q * (r["n"] - 1)), math.ceil(q * (r["n"] - 1))) for q in qs]
        before = 0
        for b, t in totals[g]:
            for rank in {x for _, lo, hi in asked[g] for x in (lo, hi)}:
                if before <= rank < before + t:
                    wanted.add((g, b, before, rank))
            before += t
    ranks = spark.createDataFrame(sorted(wanted, key=str), f"{kind}, b int, before bigint, rank bigint")
    inside = Window.partitionBy("g", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = (tagged.join(ranks.select("g", "b").distinct(), ["g", "b"], "left_semi")
              .withColumn("start", F.coalesce(F.sum("c").over(inside), F.lit(0))).join(ranks, ["g", "b"]))
    start = F.col("before") + F.col("start")
    found = {(r["g"], r["rank"]): r["v"] for r in placed.where(
        (start <= F.col("rank")) & (F.col("rank") < start + F.col("c"))).select("g", "rank", "v").collect()}
    out = {}
    for g, targets in asked.items():
        out[g] = []
        for at, lo, hi in targets:
            a, b = found[g, lo], found[g, hi]
            out[g].append(a + (b - a) * (at - lo))
    return out


def column_quantiles(df: DataFrame, cols: list[str], qs: list[float], **kw) -> dict:
    """{column: [quantile per q]} for several numeric columns at once."""
    if not cols:
        return {}
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("g"), F.col(c).cast("double").alias("v")) for c in cols]))
    got = grouped_quantiles(df.select(stacked.alias("p")).select("p.g", "p.v"), qs, **kw)
    return {c: got.get(c, [None] * len(qs)) for c in cols}
