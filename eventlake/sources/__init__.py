"""Readers for bronze, silver and rejected events."""
