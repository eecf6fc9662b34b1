"""Operators of a training-data pipeline over documents and pages.

Nothing outside this subpackage imports it.
"""
