"""Reading files and publishing tables."""
