"""Column expressions shared by the rollups; all of them stay inside the JVM."""
