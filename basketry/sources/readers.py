"""Readers: raw CSV / Parquet inputs with fixed schemas, and the two summary
tables with typed dates (IO-01 .. IO-03, IO-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas

RAW_FILES = {name: f"{name}.csv" for name in schemas.INPUTS}


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             date_cols=(), id_cols=()) -> DataFrame:
    """CSV with a header.  Every column is read as text and typed afterwards:
    dates with ``try_to_timestamp`` (bad text -> null), other columns with
    ``try_cast``; ids stay text."""
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .option("multiLine", False).option("escape", '"')
           .schema(T.StructType([T.StructField(f.name, T.StringType(), True)
                                 for f in schema.fields]))
           .csv(path))
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.name in date_cols or isinstance(f.dataType, T.TimestampType):
            c = F.try_to_timestamp(c)
        elif f.name in id_cols or isinstance(f.dataType, T.StringType):
            c = c
        else:
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def read_input(spark: SparkSession, name: str, path: str, fmt: str = "csv") -> DataFrame:
    """One of the seven raw inputs, typed by its fixed schema."""
    schema = schemas.INPUTS[name]
    if fmt == "csv":
        return read_csv(spark, path, schema)
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_inputs(spark: SparkSession, directory: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """IO-01: all seven raw inputs from one folder (``<name>.csv`` or
    ``<name>.parquet`` each), lazily."""
    base = directory.rstrip("/")
    ext = "csv" if fmt == "csv" else fmt
    return {name: read_input(spark, name, f"{base}/{name}.{ext}", fmt)
            for name in schemas.INPUTS}


def read_customers(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """IO-02 / IO-03: customer summary, ``signup_date`` typed, id as text."""
    return _read_summary(spark, path, fmt, ("signup_date",), ("customer_id",))


def read_orders(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """IO-02 / IO-03: order summary, three date columns typed, ids as text.

    ``return_date`` may hold several comma-joined dates in one cell (the
    reference joins them); such a cell stays null here and the list form is
    kept in ``return_dates`` (array<timestamp>)."""
    df = _read_summary(spark, path, fmt, ("order_date", "signup_date"),
                       ("customer_id", "order_id"), keep_text=("return_date",))
    if "return_date" in df.columns:
        parts = F.split(F.col("return_date"), ",")
        df = (df.withColumn("return_dates",
                            F.transform(parts, lambda s: F.try_to_timestamp(F.trim(s))))
                .withColumn("return_date", F.try_to_timestamp(F.col("return_date"))))
    return df


def _read_summary(spark, path, fmt, date_cols, id_cols, keep_text=()) -> DataFrame:
    if fmt == "csv":
        df = spark.read.option("header", True).option("escape", '"').csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    out = []
    for name in df.columns:
        c = F.col(name)
        if name in date_cols:
            c = F.try_to_timestamp(c.cast("string")) if fmt == "csv" else c.cast("timestamp")
        elif name in id_cols or name in keep_text:
            c = c.cast("string")
        out.append(c.alias(name))
    return df.select(*out)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """IO-10: a published table, whole (preview with ``.limit(n)``)."""
    return spark.table(name)
