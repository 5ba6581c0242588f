"""Reading landed files and tables."""
