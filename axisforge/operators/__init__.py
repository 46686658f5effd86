"""Operators on DataFrames of events, hemispheres and files."""
