"""Operators for preparing text corpora at scale (near-duplicate removal, archives, filters, packing, sampling).

Each module holds one operator with its own general interface; ``queries.py``
registers the queries over the driver tables. Nothing outside this package
imports it.
"""
