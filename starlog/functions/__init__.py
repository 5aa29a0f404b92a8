"""Column-to-column helpers, all built from JVM-side expressions."""
