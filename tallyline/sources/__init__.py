"""Readers and source-shaping operators."""
