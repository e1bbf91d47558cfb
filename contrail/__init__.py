"""Flight-traffic analytics as Spark DataFrame transformations."""
