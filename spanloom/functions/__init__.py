"""Column expressions. Everything here runs inside the JVM."""
