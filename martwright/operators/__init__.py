"""Silver, Gold and audit operators; each maps DataFrames to a DataFrame."""
