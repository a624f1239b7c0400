"""Column expressions; all are built-in Catalyst expressions."""
