"""Column functions: everything stays inside generated JVM code."""
