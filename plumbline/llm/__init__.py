"""Operators for large text corpora, each written by one named method.

Nothing else in the library imports this subpackage.
"""
