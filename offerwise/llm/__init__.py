"""Operators for preparing training text: scans, fingerprints, filters, deduplication, packing, encoding.

Each operator takes a DataFrame and returns one; the registered queries derive their digest columns
from the operators' results. Nothing else in the library imports this package.
"""
