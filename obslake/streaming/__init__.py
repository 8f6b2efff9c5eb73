"""The operators on file streams."""
