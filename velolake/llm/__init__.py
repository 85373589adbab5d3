"""Operators for preparing training text at scale, their queries and their comparison SQL.

Nothing else in the library imports this subpackage.
"""
