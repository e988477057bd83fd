"""Single operators on DataFrames."""
