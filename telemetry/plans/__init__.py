"""Whole user queries (analysis, quality) and the registry of queries with their oracles."""
