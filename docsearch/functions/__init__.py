"""Column-to-column helpers that stay inside generated code."""
