"""Structured Streaming forms of the generation job."""
