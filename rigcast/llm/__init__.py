"""Operators for building language-model training data.

Nothing else in the library imports this subpackage; it only borrows the
session and scratch-storage helpers. Each module holds one operator and the
registered query that applies it to its whole table.
"""
