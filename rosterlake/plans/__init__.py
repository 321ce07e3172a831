"""Whole jobs built from the operators: snapshots on disk, indexing, search requests, feeds."""
