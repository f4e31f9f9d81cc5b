"""Column-level building blocks (pure expressions, no UDFs)."""
