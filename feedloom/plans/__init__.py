"""Whole jobs composed from the operators."""
