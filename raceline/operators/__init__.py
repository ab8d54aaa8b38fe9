"""Reusable DataFrame operators (ingestion building blocks, joins, checks)."""
