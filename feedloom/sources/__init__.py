"""Readers: feed files, landed files, warehouse tables, generated series."""
