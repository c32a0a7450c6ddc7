"""Operators for large training-text pipelines, one module each.

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries and their SQL twins.
"""
