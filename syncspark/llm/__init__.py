"""Operators over text corpora: cleaning, deduplication, encoding, packing, search.

Nothing else in the package imports this folder.
"""
