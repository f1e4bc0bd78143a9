"""Joins, identity, lineage, history and aggregation operators."""
