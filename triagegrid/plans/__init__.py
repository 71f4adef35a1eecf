"""Report plans. Each takes the canonical tables by name and explicit parameters and returns lazy DataFrames."""
