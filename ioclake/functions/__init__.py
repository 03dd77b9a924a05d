"""Column-expression builders (pure Spark SQL, no Python UDFs)."""
