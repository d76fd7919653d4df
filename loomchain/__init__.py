"""loomchain: chain-data indexing and analysis as plain Spark DataFrame jobs."""
