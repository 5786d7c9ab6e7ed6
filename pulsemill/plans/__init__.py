"""Compositions of operators: ingest and saved panel queries."""
