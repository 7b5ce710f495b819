"""Readers, writers and adapters that produce or store the canonical frames."""
