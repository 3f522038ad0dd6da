"""Column-level functions (pure Catalyst expressions unless noted)."""
