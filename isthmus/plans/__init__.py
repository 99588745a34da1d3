"""Predicates, work units and scans."""
