"""Column → Column expressions, all JVM-side."""
