"""Column expressions; all of them stay in the JVM."""
