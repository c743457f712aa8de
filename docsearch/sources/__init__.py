"""Reading entity tables and reading or writing index tables."""
