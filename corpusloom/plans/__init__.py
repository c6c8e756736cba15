"""Whole queries: compositions of the operators, bound to tables."""
