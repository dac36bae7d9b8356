"""Whole jobs built from the operators: ingest, municipal table, cluster analysis."""
