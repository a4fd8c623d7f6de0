"""Column builders and helpers that stay in the JVM."""
