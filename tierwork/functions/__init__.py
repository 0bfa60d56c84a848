"""Column expressions shared by the operators; all built-in, none leaves the JVM."""
