"""emberlog: finding anomalies in service logs with Spark DataFrames."""
