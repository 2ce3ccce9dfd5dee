"""Operators of a training-data pipeline: filters, deduplication, mixing, tokens, chat turns.

Every operator takes and returns DataFrames. Nothing else in the library imports this package.
"""
