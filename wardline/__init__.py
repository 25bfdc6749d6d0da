"""Security-control analytics as Spark DataFrame operators."""
