"""Scans, landing and table writes."""
