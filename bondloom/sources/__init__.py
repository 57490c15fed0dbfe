"""Readers of landed documents and the state reductions behind the tables."""
