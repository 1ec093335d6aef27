"""Sinks and catalog (IO-04 .. IO-09).  Every write is overwrite-mode, so a
second run replaces instead of colliding."""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession

#: what follows the name of a published table in those of its versions
_VERSION = r"__\d{20}"


def write_csv(df: DataFrame, path: str) -> None:
    """IO-04: CSV with a header, no index.  Array columns are joined first
    because CSV has no list type."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    cols = [F.array_join(F.col(f.name).cast("array<string>"), ",").alias(f.name)
            if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by=()) -> None:
    """IO-05: Parquet, the folder is made as needed."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def register_inputs(inputs: dict[str, DataFrame]) -> None:
    """IO-06: expose frames as named tables (replacing)."""
    for name, df in inputs.items():
        df.createOrReplaceTempView(name)


def _versions(spark: SparkSession, name: str) -> list[str]:
    """Stored versions of a published table, oldest first."""
    short = name.split(".")[-1]
    prefix = name[:len(name) - len(short)]
    return sorted(prefix + t.name for t in spark.catalog.listTables(prefix[:-1] or None)
                  if re.fullmatch(re.escape(short.lower()) + _VERSION, t.name.lower()))


def _drop_version(spark: SparkSession, table: str) -> None:
    """Drop a version with its files (a table with a path of its own leaves them)."""
    where = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location"]
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    for location in where:
        _delete(spark, location)


def _delete(spark: SparkSession, location: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_table(spark: SparkSession, name: str) -> None:
    """IO-08: drop a view or table of that name, if one exists, and the versions
    that ``publish`` stored under it."""
    spark.catalog.dropTempView(name)
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} IF EXISTS {name}")
    for version in _versions(spark, name):
        _drop_version(spark, version)


def publish(df: DataFrame, name: str, path: str | None = None,
            bucket_by: str | None = None, buckets: int = 0) -> None:
    """IO-07: store a query result under ``name``, replacing an older one.

    The rows are written as a new version, a table of its own; then the view
    ``name`` is pointed at it in one step.  A reader always finds a whole table, a
    failed write leaves the old one, and a query that is reading the version
    before can end: the last two versions are kept.

    ``bucket_by`` co-locates the table on its join key so later joins on that
    key read without an exchange (all marts share ``customer_id``); the view
    hands the buckets on."""
    spark = df.sparkSession
    version = f"{name}__{time.time_ns():020d}"
    folder = f"{path.rstrip('/')}/{version.split('.')[-1]}" if path else None
    w = df.write.mode("errorifexists").format("parquet")
    if folder:
        w = w.option("path", folder)
    if bucket_by and buckets:
        w = w.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    try:
        w.saveAsTable(version)
    except Exception:
        if spark.catalog.tableExists(version):
            _drop_version(spark, version)
        elif folder:
            _delete(spark, folder)
        raise
    spark.catalog.dropTempView(name)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")     # stored by other means; a view cannot replace a table
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in _versions(spark, name)[:-2]:
        _drop_version(spark, old)


def list_tables(spark: SparkSession) -> list[str]:
    """IO-09: names of the tables and views of the current database (without
    the versions behind published ones)."""
    return sorted(t.name for t in spark.catalog.listTables() if not re.search(_VERSION + "$", t.name))
