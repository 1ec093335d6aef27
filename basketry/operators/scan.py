"""Distributed running sums over an ordered key.

A window ordered over a whole table runs in one task.  Here the rows are dealt
by ranges of the key (as many as a shuffle has partitions) and written once with
the number of their range; each range is summed on its own, the range totals
give each range its starting offset, and the running sum inside a range is a
window partitioned by range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.quantiles import range_count
from basketry.session import materialise


def running_sums(df: DataFrame, order_col: str, value_cols: list[str], ranges: int | None = None,
                 group: str | None = None) -> DataFrame:
    """Add ``<v>_before`` = sum of ``v`` over rows with a strictly smaller
    ``order_col`` for each value column.  ``order_col`` must be unique per
    row (group by it first); with ``group`` both hold inside each of its values,
    and a range may hold several groups or a part of one."""
    by = [group] if group else []
    dealt = df.repartitionByRange(ranges or range_count(df), *by, order_col)
    # the partition is the range
    tagged = materialise(dealt.withColumn("_range", F.spark_partition_id()), "running")
    totals = tagged.groupBy(*by, "_range").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    # one row per range
    over = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(g).alias("_g") for g in by], F.col("_range").alias("_r"),
                            *[F.coalesce(F.sum(f"_t_{v}").over(over), F.lit(0)).alias(f"_o_{v}") for v in value_cols])
    inside = Window.partitionBy(*by, "_range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_range") == F.col("_r")
    if group:
        same = same & F.col(group).eqNullSafe(F.col("_g"))
    out = tagged.join(F.broadcast(offsets), same, "left")
    return out.select(*df.columns, *[
        (F.col(f"_o_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"{v}_before") for v in value_cols])
