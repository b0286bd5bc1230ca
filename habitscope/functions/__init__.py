"""Column builders. All of them return JVM-side expressions; no Python UDFs."""
