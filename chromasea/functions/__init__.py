"""Column builders: every function takes and returns a Spark ``Column``."""
