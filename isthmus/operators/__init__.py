"""Relational queries over scans, and checks of results."""
