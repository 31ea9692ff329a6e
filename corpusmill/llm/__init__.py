"""Operators for building language-model training data.

Each module holds one operator with its own interface; ``queries`` derives the
registered queries from them.  Nothing else in the library imports this package.
"""
