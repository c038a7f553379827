"""Dataset operators: collapse, fuse, expectations, validation, checks."""
