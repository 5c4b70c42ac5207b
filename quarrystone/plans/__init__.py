"""The models: staging, core and marts, each a function from DataFrames to one DataFrame."""
