"""martloom: a retail mart engine of pure DataFrame operators for PySpark.

functions  column expressions (weeks, ratios, labels)
operators  DataFrame -> DataFrame building blocks (calendar, sales, returns, dimensions, customers)
sources    CSV, Parquet and JDBC readers, as-of snapshot filters, discovery
plans      whole jobs: snapshot extract, sales mart, marketing mart, publishing
"""
