"""Order analytics on Spark: batch and streaming operators over order data."""
