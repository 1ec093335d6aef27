from basketry.sources.readers import (  # noqa: F401
    read_csv, read_customers, read_input, read_inputs, read_orders, read_table,
)
from basketry.sources.sinks import (  # noqa: F401
    drop_table, list_tables, publish, register_inputs, write_csv, write_parquet,
)
from basketry.sources.testdata import test_inputs  # noqa: F401
