"""Aeronautical, geospatial and text data preparation on Spark DataFrames."""
