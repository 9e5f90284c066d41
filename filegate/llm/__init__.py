"""Operators of a training-data pipeline: each module holds one operator and states in its
docstrings what it returns for nulls, empty and long texts, ties, repeated rows, empty tables
and clashing column names. ``queries`` binds them to the tables of a dataset folder.
"""
