"""Market-data history on Spark: canonical tables, catalog questions, streams."""
