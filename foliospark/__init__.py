"""Document evidence analytics as Spark DataFrame operators."""
