"""Operators for text corpora: deduplication, filtering, scanning, counting and packing.

Nothing else in the package imports this folder.
"""
