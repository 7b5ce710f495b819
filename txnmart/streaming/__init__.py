"""Incremental loads of newly landed raw rows."""
