"""Sources of DataFrames."""
