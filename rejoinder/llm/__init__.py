"""Operators for preparing training text: deduplication, counting, filtering, search, packing.

Nothing else in the package imports from here.
"""
