"""Score monitoring on Spark: percentiles, stability, separation and capture per cohort and segment."""
