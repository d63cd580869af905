"""Click analytics on Spark: JSON click feeds, running counts and keyed result tables."""
