"""Null fills from global statistics (C-03 median fill, C-04 mode fill) and
the null profile (A-31).

Medians are numbers and return to the plan as literals.  Modes may be texts of
any size: they stay in a small written table (one row per column) and reach the
fill as scalar subqueries, so no text passes the driver.  Statistics can be
taken from narrow weighted rows ``(g, v, w)`` instead of the table that is
filled, so a wide join need not run for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.quantiles import column_quantiles, grouped_quantiles
from basketry.session import materialise


def stacked(df: DataFrame, cols: list[str], kind: str, weight: str | None = None) -> DataFrame:
    """Rows (g = column name, v = its value cast to ``kind``, w) of several columns."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("g"), F.col(c).cast(kind).alias("v")) for c in cols]))
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    return df.select(pairs.alias("p"), w.alias("w")).select("p.g", "p.v", "w")


def medians(df: DataFrame, cols: list[str], approx: bool = False) -> dict[str, float | None]:
    """A-26: exact median (linear interpolation) per column, nulls skipped.
    ``approx=True`` uses ``percentile_approx`` in one job instead."""
    if not cols:
        return {}
    if approx:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 100_000).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    return {c: v[0] for c, v in column_quantiles(df, cols, [0.5]).items()}


def weighted_medians(pairs: DataFrame) -> dict[str, float]:
    """Medians of weighted rows (g, v, w), by group."""
    return {g: v[0] for g, v in grouped_quantiles(pairs, [0.5]).items()}


def mode_table(pairs: DataFrame) -> DataFrame:
    """A-27: (g, v) with the value of most weight per group of (g, v, w), nulls
    skipped, ties -> smallest.  Values are counted by a 128-bit hash; only the
    values that win or tie are looked up again as texts."""
    rows = pairs.where(F.col("v").isNotNull()).withColumn("h", F.unhex(F.md5("v")))
    counted = materialise(rows.groupBy("g", "h").agg(F.sum("w").alias("n")), "mode-counts")
    best = counted.groupBy("g").agg(F.max("n").alias("n"))
    winners = counted.join(best, ["g", "n"]).select("g", "h")
    return rows.join(winners, ["g", "h"], "left_semi").groupBy("g").agg(F.min("v").alias("v"))


def modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """A-27 for the columns of a table: (g, v), one row per column with a value."""
    return mode_table(stacked(df, cols, "string"))


def fill_medians(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """C-03 with given medians: nulls -> median, the columns become double."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double")) for c, v in values.items()})


def fill_modes(df: DataFrame, table: DataFrame, cols: list[str], written: bool = False) -> DataFrame:
    """C-04 with a table (g, v) of modes: nulls -> mode, cast to the column's type.
    The table is read once per column, so it is written first unless it is."""
    types = dict(df.dtypes)
    table = table if written else materialise(table, "modes")
    return df.withColumns({c: F.coalesce(F.col(c), table.where(F.col("g") == c).select("v").scalar().cast(types[c]))
                           for c in cols})


def median_fill(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """C-03: nulls of each listed numeric column replaced by its median."""
    cols = [c for c in cols if c in df.columns]
    return fill_medians(df, medians(df, cols, approx))


def mode_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    """C-04: nulls of each listed column replaced by its mode."""
    cols = [c for c in cols if c in df.columns]
    return fill_modes(df, modes(df, cols), cols)


def zero_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    """``fill="zero"`` alternative to the median fill (D8)."""
    cols = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})


def null_profile(df: DataFrame) -> DataFrame:
    """A-31: null count per column, one row per column (column, nulls)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("nulls"))
                                for c in df.columns]))
    return counts.select(stack.alias("s")).select("s.column", "s.nulls")
