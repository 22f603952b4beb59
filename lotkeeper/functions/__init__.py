"""Column expressions: pure functions from Column to Column, all inside the JVM."""
