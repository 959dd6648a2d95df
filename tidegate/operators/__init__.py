"""Set-based operators: DataFrames and columns in, lazy DataFrames out."""
