"""Compositions of the operators: whole jobs, and the registered queries."""
