"""Operators for preparing training data, and their queries.

Nothing else in the library imports this subpackage.
"""
