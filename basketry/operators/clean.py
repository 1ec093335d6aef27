"""Cleaning (C-01, C-02, C-05): one projection per table, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import has
from basketry.schemas import CLEAN_CUSTOMER_NUMERIC, CLEAN_ORDER_NUMERIC
from basketry.sources.sinks import write_parquet

def _coerce_zero(df: DataFrame, c: str) -> F.Column:
    """Text or number -> double; unparsable or null -> 0."""
    x = F.col(c)
    if dict(df.dtypes)[c] == "string":
        x = F.trim(x).try_cast("double")
    return F.coalesce(x.cast("double"), F.lit(0.0))


def _text_or(df: DataFrame, c: str, word: str) -> F.Column:
    """Null -> ``word``; an absent column stays an all-null column (PF-12)."""
    if not has(df, c):
        return F.lit(None).cast("string")
    return F.coalesce(F.col(c).cast("string"), F.lit(word))


def clean_customers(df: DataFrame) -> DataFrame:
    """C-01: numeric columns coerced (bad or missing -> 0); gender null ->
    'Unknown', loyalty_status null -> 'None'."""
    fixes = {c: _coerce_zero(df, c) for c in CLEAN_CUSTOMER_NUMERIC if has(df, c)}
    fixes["gender"] = _text_or(df, "gender", "Unknown")
    fixes["loyalty_status"] = _text_or(df, "loyalty_status", "None")
    return df.withColumns(fixes)


def clean_orders(df: DataFrame) -> DataFrame:
    """C-02: numeric columns coerced; missing categories / subcategories ->
    'Unknown' (an empty list is missing, as after a trip through CSV)."""
    fixes = {c: _coerce_zero(df, c) for c in CLEAN_ORDER_NUMERIC if has(df, c)}
    for c in ("categories", "subcategories"):
        if has(df, c):
            fixes[c] = F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("Unknown"))
    return df.withColumns(fixes)


def clean_and_publish(customers: DataFrame, orders: DataFrame, directory: str):
    """C-05: clean both summaries and store them as Parquet under
    ``directory``; returns the stored tables read back."""
    base = directory.rstrip("/")
    write_parquet(clean_customers(customers), f"{base}/customers_clean.parquet")
    write_parquet(clean_orders(orders), f"{base}/orders_clean.parquet")
    spark = customers.sparkSession
    return (spark.read.parquet(f"{base}/customers_clean.parquet"),
            spark.read.parquet(f"{base}/orders_clean.parquet"))
