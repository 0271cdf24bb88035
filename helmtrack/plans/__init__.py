"""Composed queries over the operators."""
