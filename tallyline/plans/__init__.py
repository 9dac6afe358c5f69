"""Whole flows and reports composed from the operators."""
