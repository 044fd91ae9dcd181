"""Operators for large-scale training-data pipelines.

Each module takes DataFrames and column names and returns a DataFrame.
``queries.py`` applies them to the whole ``documents`` table. Nothing outside
this subpackage imports it.
"""
