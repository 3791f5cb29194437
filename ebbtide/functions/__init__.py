"""Column expressions; all of them stay in JVM code generation."""
