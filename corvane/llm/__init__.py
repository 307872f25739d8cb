"""Operators for training data: cleaning, deduplication, scans, tokens and chat formats.

Nothing else in the library imports this package.
"""
