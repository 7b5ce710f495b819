"""Transaction mart on Spark: clean, validate, deduplicate, model, measure, generate."""
