"""basketry: customer and order analytics as lazy Spark DataFrame operators.

Layout
------
sources/    readers, sinks, catalog publishing, test-table adapter
functions/  column-level helpers (safe division, day arithmetic, lgamma, ...)
operators/  DataFrame -> DataFrame operators (marts, summaries, cleaning,
            exploration, features, churn, lifetime value, statistics)
plans/      query registry used by ``__spark_entry__`` and ``bench.py``
"""

__version__ = "0.1.0"
