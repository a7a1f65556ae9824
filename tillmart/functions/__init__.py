"""Column helpers. None of them reads a clock or leaves the JVM."""
