"""Weather and news analytics on Spark: landed answers in, city reports out."""
