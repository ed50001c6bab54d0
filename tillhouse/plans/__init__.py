"""The four layers. Each table is one function from DataFrames to a DataFrame; nothing here reads a
catalog or writes a result."""
