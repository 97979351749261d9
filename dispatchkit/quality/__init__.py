"""Data-quality rules as data, compiled to a few DataFrame plans."""
