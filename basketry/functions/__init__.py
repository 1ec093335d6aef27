from basketry.functions.columns import (  # noqa: F401
    days_between, distinct_join, has, lgamma, list_size, safe_div, whole_days_between,
)
