"""The tables, layer by layer. Each is a function from DataFrames to a DataFrame."""
