"""Operators for large text corpora: token files, packing, filters, near duplicates, language model scores.

Each operator is a function from DataFrames to DataFrames; ``queries`` registers one query per operator.
"""
