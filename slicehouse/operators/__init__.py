"""Reports and status questions, from DataFrames to DataFrames."""
