"""Spark jobs over landed financial-market tables."""
