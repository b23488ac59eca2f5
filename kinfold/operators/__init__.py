"""Graph operators; each takes and returns DataFrames."""
