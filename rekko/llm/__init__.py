"""Operators for preparing large training corpora (dedup, tokens, search, filters).

Nothing else in the library imports this subpackage.
"""
