"""Operators of a training-data pipeline: scans, counts, deduplication, classification, search, decontamination and mixing.

Nothing else in the library imports this package. Operators take DataFrames and name their id and text columns; `queries` registers one query for each.
"""
