"""Whole jobs, chained from operators."""
