"""Composed analyses, query registry and SQL oracle."""
