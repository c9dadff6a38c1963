"""Purchase-funnel analytics over e-commerce event logs, on Spark DataFrames."""
