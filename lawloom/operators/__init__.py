"""Operators on DataFrames: classification, amendment graphs, deltas, merges, hierarchies."""
