"""Column functions and cleaning steps."""
