"""shelfcast: leakage-safe retail demand forecasting as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame`` (column names are
parameters), so Catalyst sees one declarative plan per query: scans are
pruned and filtered at the parquet reader, series windows share one
exchange, and small grain tables are joined back to the panel.
"""

__version__ = "0.1.0"
