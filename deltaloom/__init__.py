"""Change data capture on Spark: a row-level change log in, change events out, in batch and in streams."""
