"""Operators for training-data pipelines over large document tables.

Every operator takes and returns DataFrames. Nothing else in the library imports this subpackage.
"""
