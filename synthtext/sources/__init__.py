"""Prompt and record readers."""
