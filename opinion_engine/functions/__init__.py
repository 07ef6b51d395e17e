"""Column expressions: each takes and returns a ``Column`` and stays in the JVM."""
