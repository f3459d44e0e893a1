"""Column-expression helpers (all built-in Catalyst expressions, no UDFs)."""
