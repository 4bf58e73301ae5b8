"""Card-ledger analytics on Spark DataFrames and Structured Streaming."""
