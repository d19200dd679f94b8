"""Landed files -> DataFrames. Fetching ends at the landing folder."""
