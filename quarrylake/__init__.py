"""quarrylake: lakehouse data operators written as Spark DataFrame jobs."""
