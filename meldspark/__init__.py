"""Customer-data consolidation and everyday analytics as Spark DataFrame operators."""
