"""Data preparation and reconciliation on Spark DataFrames.

Every operator is a plain function from DataFrames to DataFrames. See ``operators`` for single
steps, ``functions`` for column helpers, ``sources`` for reading and writing, ``plans`` for whole
jobs (profile, reconcile, compare, reports).
"""
