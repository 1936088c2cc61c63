"""Plant and pricing analytics on Spark: operators, sources and domain tables."""
