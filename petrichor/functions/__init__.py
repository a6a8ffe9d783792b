"""Column expressions; every one of them stays on the JVM side."""
