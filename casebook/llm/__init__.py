"""Operators for preparing training text at scale.

Each module holds one operator; ``queries`` applies them to whole tables. Every operator takes
DataFrames and column names, reads only the columns it names, and leaves other columns alone.
"""
