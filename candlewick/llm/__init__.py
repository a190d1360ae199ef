"""Training-data operators: cleaning, deduplication, packing, sharding.

Nothing else in the library imports this package.
"""
