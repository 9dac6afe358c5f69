"""Frame-to-frame operators."""
