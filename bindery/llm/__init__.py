"""Operators that prepare text for training language models.

Each module holds one operator with a general interface. ``queries`` applies them
to the given tables. Nothing else in the library imports this subpackage.
"""
