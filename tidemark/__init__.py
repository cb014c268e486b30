"""Customer analytics on Spark: feature windows, preparation, models, scoring."""
