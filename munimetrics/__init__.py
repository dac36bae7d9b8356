"""Municipal service-inequality analytics as Spark DataFrame operators."""
