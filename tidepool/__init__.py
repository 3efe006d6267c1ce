"""Product-usage analytics on Spark DataFrames: cleaning, star schema, metrics, data quality."""
