"""The daily operators on streams."""
