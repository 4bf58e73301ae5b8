"""Whole batch jobs composed from the operators."""
