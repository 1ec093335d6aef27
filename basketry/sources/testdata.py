"""Adapter: the driver's TPC-H-like test tables -> the seven shop inputs.

Every missing column is arithmetic on keys (see FIXTURES.md section 2), so
the same rows can be rebuilt independently in SQL for the oracle checks.
Whole tables, pure projections: no shuffle, and Catalyst prunes the columns each
consumer does not need down to the Parquet scan.  Orders of every 20th customer
key are guest orders: their customer id has no row in ``customers_dim``, so
customers without orders and orders without a customer both occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter (they must equal the oracle text).
AGE_GROUPS = ["18-25", "26-35", "36-50", "51+"]          # by c_nationkey % 4
CHANNELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]  # by s_suppkey % 4
REASONS = ["damaged", "late", "wrong item", "changed mind", None]  # by l_partkey % 5
STATUS = {"F": "Delivered", "O": "Shipped", "P": "Cancelled"}
INTERACTION_TYPES = {"error": "support", "signup": "return", "view": "review"}
SIGNUP_BASE = "1995-01-01"
GUEST = "guest-"


def _pick(index: F.Column, values) -> F.Column:
    expr = None
    for i, v in enumerate(values):
        cond = index == i
        lit = F.lit(v).cast("string")
        expr = F.when(cond, lit) if expr is None else expr.when(cond, lit)
    return expr


def _map(col: F.Column, mapping: dict, default=None) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(default if default is not None else F.lit(None).cast("string"))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    signup = F.date_sub(F.lit(SIGNUP_BASE).cast("date"), (F.col("c_custkey") % 720).cast("int"))
    key5 = F.col("c_custkey") % 5
    bal = F.col("c_acctbal")
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        signup.cast("timestamp").alias("signup_date"),
        F.date_format(signup, "yyyy-MM").alias("cohort"),
        F.when(key5 <= 1, "F").when(key5 <= 3, "M").alias("gender"),
        _pick(F.col("c_nationkey") % 4, AGE_GROUPS).alias("age_group"),
        F.col("c_mktsegment").alias("acquisition_channel"),
        F.when(bal < 0, F.lit(None).cast("string")).when(bal < 3000, "Bronze")
         .when(bal < 7000, "Silver").otherwise("Gold").alias("loyalty_status"),
    )


def orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    disc = F.col("o_orderkey") % 50
    key = F.col("o_custkey").cast("string")
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_custkey") % 20 == 19, F.concat(F.lit(GUEST), key)).otherwise(key).alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("order_amount"),
        F.when(disc != 49, disc.cast("decimal(18,2)")).alias("discount_amount"),
        _map(F.col("o_orderstatus"), STATUS).alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def _item_id() -> F.Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    return li.select(
        _item_id().alias("order_item_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )


def products_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % 25 != 24, F.col("p_type")).alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
    )


def customer_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("interaction_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        _map(F.col("event_type"), INTERACTION_TYPES, F.col("event_type")).alias("type"),
        F.when(F.col("event_id") % 10 != 9, F.col("props")).alias("text"),
    )


def marketing_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.cast("string").alias("campaign_id"),
        _pick(k % 4, CHANNELS).alias("channel"),
        F.abs(F.col("s_acctbal").cast("decimal(18,2)")).alias("spend"),
        (F.lit(1000) + (k * 37) % 5000).cast("bigint").alias("impressions"),
        ((k * 7) % 100).cast("bigint").alias("clicks"),
    )


def returns_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_returnflag") == "R").select(
        _item_id().alias("return_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_shipdate").cast("timestamp").alias("return_date"),
        _pick(F.col("l_partkey") % 5, REASONS).alias("reason"),
    )


ADAPTERS = {
    "customers_dim": customers_dim,
    "orders_fact": orders_fact,
    "order_items": order_items,
    "products_dim": products_dim,
    "customer_interactions": customer_interactions,
    "marketing_spend": marketing_spend,
    "returns_refunds": returns_refunds,
}


class _Inputs(dict):
    """The seven inputs keyed by table name, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name not in ADAPTERS:
            raise KeyError(name)
        df = self[name] = ADAPTERS[name](self._spark, self._dir)
        return df

    def keys(self):
        return ADAPTERS.keys()

    def __iter__(self):
        return iter(ADAPTERS)

    def __len__(self):
        return len(ADAPTERS)

    def items(self):
        return [(n, self[n]) for n in ADAPTERS]

    def values(self):
        return [self[n] for n in ADAPTERS]


def test_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All seven inputs keyed by table name; each is built when first used."""
    return _Inputs(spark, sf_dir)
