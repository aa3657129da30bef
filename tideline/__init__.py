"""Lifecycle analytics on Spark: landed raw files to typed, keyed, daily tables."""
