"""Column-level functions (no shuffles)."""
