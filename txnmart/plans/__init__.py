"""Whole-mart builds and report bundles composed from the operators."""
