"""Column expressions; all native, none raises on bad text."""
