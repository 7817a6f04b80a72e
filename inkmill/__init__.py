"""inkmill: text-corpus preparation and evaluation as Spark DataFrame jobs."""
