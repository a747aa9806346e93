"""Web-visit analytics on Spark DataFrames.

Raw visit exports (CSV or Parquet) become a typed per-visit KPI table, then a
small star schema.  Every public function takes and returns DataFrames; the
caller owns the SparkSession and its settings.
"""
