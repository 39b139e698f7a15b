"""Customer-funnel analytics on PySpark: features, segments, scores and action lists."""
