"""Change operations on streams."""
