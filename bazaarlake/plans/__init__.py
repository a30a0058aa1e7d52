"""Compositions of operators: the daily run and the registered queries."""
