"""Operators for preparing training text, with their queries.

Nothing else in the library imports this folder.
"""
