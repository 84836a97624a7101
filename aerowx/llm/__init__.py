"""Operators for preparing training data: extraction, de-duplication, scoring, mixing, packing.

Each operator takes DataFrames and gives DataFrames; ``queries`` applies them to whole
tables. Nothing outside this folder imports from it.
"""
