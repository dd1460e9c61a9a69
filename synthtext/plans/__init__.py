"""Batch job and the registry of queries over the driver tables."""
