"""Operators of a training-data pipeline on DataFrames (one module each) and
the queries that apply them to the given tables (``queries``)."""
