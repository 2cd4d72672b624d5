"""Column helpers: declared types and enum codes."""
