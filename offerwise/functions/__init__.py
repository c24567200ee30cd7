"""Column expressions without state."""
