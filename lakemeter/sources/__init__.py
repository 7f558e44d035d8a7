"""Landed payload scans, parsing and source contracts."""
