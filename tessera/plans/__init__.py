"""Bindings of the operators to the test tables (queries and oracle SQL)."""
