"""Column expressions. Every one stays in the JVM."""
