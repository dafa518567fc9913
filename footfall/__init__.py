"""Visit analytics on Spark: captures of visitors in, daily derived tables out."""
