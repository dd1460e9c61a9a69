"""Record, metric and sample writers."""
