"""Citation-graph analytics on Spark."""
