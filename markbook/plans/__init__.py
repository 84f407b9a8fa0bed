"""Whole jobs: enrichment of raw rows, summary, loads, weekly update."""
