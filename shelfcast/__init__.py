"""shelfcast — daily retail demand analytics as Spark DataFrame operators.

Layout:
  sources/    readers and writers (CSV retail files, star-schema tables, parquet sinks)
  plans/      panel derivation (dense item x store x day table) and the query catalog
  functions/  Column-level scalar helpers (calendar, events, guarded arithmetic)
  operators/  features, forecasts, metrics, exploration, time-series analysis, models
"""

__version__ = "0.1.0"
