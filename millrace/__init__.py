"""Analytics jobs for Spark: ETL, text auditing, windows, sketches, streams, ML and privacy."""
