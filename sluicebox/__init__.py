"""Session funnel and revenue-leakage analytics as lazy Spark DataFrames."""
