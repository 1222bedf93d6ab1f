"""Whole runs and the registered queries, put together from the operators."""
