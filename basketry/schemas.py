"""Fixed schemas of the seven shop inputs and of the derived tables.

No schema inference anywhere: every reader applies one of these.
"""

from pyspark.sql import types as T

S, TS = T.StringType(), T.TimestampType()
MONEY = T.DecimalType(18, 2)
LONG = T.LongType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CUSTOMERS = _schema(
    ("customer_id", S), ("signup_date", TS), ("cohort", S), ("gender", S),
    ("age_group", S), ("acquisition_channel", S), ("loyalty_status", S))

ORDERS = _schema(
    ("order_id", S), ("customer_id", S), ("order_date", TS),
    ("order_amount", MONEY), ("discount_amount", MONEY),
    ("order_status", S), ("payment_method", S))

ORDER_ITEMS = _schema(
    ("order_item_id", S), ("order_id", S), ("product_id", S),
    ("quantity", LONG), ("price", MONEY))

PRODUCTS = _schema(
    ("product_id", S), ("category", S), ("subcategory", S), ("price", MONEY))

INTERACTIONS = _schema(
    ("interaction_id", S), ("customer_id", S), ("type", S), ("text", S))

MARKETING = _schema(
    ("campaign_id", S), ("channel", S), ("spend", MONEY),
    ("impressions", LONG), ("clicks", LONG))

RETURNS = _schema(
    ("return_id", S), ("order_id", S), ("return_date", TS), ("reason", S))

#: input name -> schema; the names are the table names the marts query
INPUTS = {
    "customers_dim": CUSTOMERS,
    "orders_fact": ORDERS,
    "order_items": ORDER_ITEMS,
    "products_dim": PRODUCTS,
    "customer_interactions": INTERACTIONS,
    "marketing_spend": MARKETING,
    "returns_refunds": RETURNS,
}

# Columns of the two summaries, by the side they come from, and
# the columns the reference fills, cleans and drops.
ORDER_SIDE_ITEMS = ["num_items", "products_in_order", "total_quantity", "total_item_price", "categories", "subcategories"]
ORDER_SIDE_RETURNS = ["num_returns", "return_date", "return_reasons"]
SIDE_CUSTOMER_ORDERS = ["num_orders", "total_order_amount", "total_discounts"]
SIDE_CUSTOMER_ITEMS = ["total_items", "unique_products", "total_quantity", "total_item_price"]
SIDE_CUSTOMER_RETURNS = ["total_returns", "return_reasons"]
SIDE_INTERACTIONS = ["num_interactions", "interaction_types", "interaction_texts"]
SIDE_CHANNEL = ["channel", "num_campaigns", "total_spend", "total_impressions", "total_clicks"]

_CHANNEL_NUMERIC = SIDE_CHANNEL[1:]
ORDER_NUMERIC_FILL = ["num_returns", "num_interactions", *_CHANNEL_NUMERIC]
ORDER_MODE_FILL = ["return_date", "return_reasons", "interaction_types", "interaction_texts", "channel"]
CUSTOMER_NUMERIC_FILL = [*SIDE_CUSTOMER_ORDERS, *SIDE_CUSTOMER_ITEMS, "total_returns", "num_interactions", *_CHANNEL_NUMERIC]
CUSTOMER_MODE_FILL = ["return_reasons", "interaction_types", "interaction_texts", "channel"]
#: numeric columns cleaning coerces
CLEAN_CUSTOMER_NUMERIC = CUSTOMER_NUMERIC_FILL
CLEAN_ORDER_NUMERIC = ["order_amount", "discount_amount", "num_items", "total_quantity", "total_item_price", "num_returns"]
ORDER_DOUBLE = ["order_amount", "discount_amount", "num_items", "total_quantity", "total_item_price", *ORDER_NUMERIC_FILL]
