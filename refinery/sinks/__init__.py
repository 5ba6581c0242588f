"""Writing: staging, tables, quality results."""
