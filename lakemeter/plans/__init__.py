"""Keyed table writes, the Bronze -> Silver -> Gold pipeline and report queries."""
