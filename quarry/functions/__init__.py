"""Column -> Column building blocks (JVM-side expressions, no Python UDFs)."""
