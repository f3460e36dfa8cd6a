"""attesta: evidence-backed company and site analytics as Spark DataFrame operators."""
