"""Operators for preparing training data: filtering, dedup, tokens, sharding, formatting.

Nothing else in the library imports this package.
"""
