"""The reference's batch scripts as Spark jobs.

``publish_marts``     the SQL-mart notebook: eight marts stored as tables
                      (IO-06 .. IO-09), replacing older ones (D3).
``write_summaries``   the merge script: order and customer summaries to
                      CSV or Parquet (IO-04, IO-05).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.operators import marts, summaries
from basketry.sources.sinks import publish, register_inputs, write_csv, write_parquet

MART_NAMES = ["customer_rfm", "customer_lifetime_value", "segment_profitability",
              "revenue_by_payment", "repeat_purchase", "customer_engagement",
              "marketing_influence", "customer_features"]


def mart_frames(inputs: dict[str, DataFrame], mode: str = "compat") -> dict[str, DataFrame]:
    c, o = inputs["customers_dim"], inputs["orders_fact"]
    return {
        "customer_rfm": marts.customer_rfm(c, o),
        "customer_lifetime_value": marts.customer_lifetime_value(c, o, inputs["order_items"], mode=mode),
        "segment_profitability": marts.segment_profitability(c, o),
        "revenue_by_payment": marts.revenue_by_payment(c, o),
        "repeat_purchase": marts.repeat_purchase(c, o),
        "customer_engagement": marts.customer_engagement(c, inputs["customer_interactions"]),
        "marketing_influence": marts.marketing_influence(c, inputs["marketing_spend"]),
        "customer_features": marts.customer_features(inputs, mode=mode),
    }


def publish_marts(spark: SparkSession, inputs: dict[str, DataFrame], base_path: str | None = None,
                  prefix: str = "", mode: str = "compat", buckets: int = 0) -> list[str]:
    """Register the inputs as views and store every mart as a table named
    ``prefix + mart``.  With ``buckets`` the tables, and the customers as
    ``prefix + customer_base``, are bucketed on customer_id, and in compat mode
    the wide mart is joined from the stored ones without an exchange.  Returns
    the marts' table names."""
    register_inputs(inputs)
    frames = mart_frames(inputs, mode)
    stored = {"customer_base": inputs["customers_dim"].select(*marts.CUSTOMER_COLS)} if buckets else {}
    for name, df in (stored | frames).items():
        table = prefix + name
        if name == "customer_features" and buckets and mode == "compat":
            df = features_from_marts(spark, prefix)
        publish(df, table, path=f"{base_path.rstrip('/')}/{table}" if base_path else None,
                bucket_by="customer_id" if buckets else None, buckets=buckets)
    return [prefix + name for name in frames]


def features_from_marts(spark: SparkSession, prefix: str = "") -> DataFrame:
    """J-07 as stored: the wide mart (compat) from the published marts.  Bucketed
    alike, they are joined bucket by bucket without an exchange."""
    return marts.join_marts({name: spark.table(prefix + name) for name in ("customer_base", *MART_NAMES[:-1])})


def write_summaries(inputs: dict[str, DataFrame], directory: str, fmt: str = "csv",
                    fill: str = "stat") -> tuple[str, str]:
    """Order and customer summaries written under ``directory``."""
    base = directory.rstrip("/")
    out = []
    for name, df in (("order_summary", summaries.order_summary(inputs, fill=fill)),
                     ("customer_summary", summaries.customer_summary(inputs, fill=fill))):
        path = f"{base}/{name}.{fmt}"
        (write_csv if fmt == "csv" else write_parquet)(df, path)
        out.append(path)
    return out[0], out[1]
