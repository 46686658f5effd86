"""Whole plans: mixing, stitching, and the queries on the test tables."""
