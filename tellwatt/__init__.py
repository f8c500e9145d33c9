"""Device availability analytics as Spark DataFrame operators."""
