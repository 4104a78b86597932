"""Quality control of station time series on Spark."""
