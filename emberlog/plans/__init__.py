"""Jobs put together from operators, and the queries that are checked against SQL."""
