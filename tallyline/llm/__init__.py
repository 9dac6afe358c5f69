"""Operators over text corpora for language-model training data."""
