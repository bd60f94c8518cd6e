"""Training-data operators: near-duplicates, token counts, sharding, mixing, packing, search.

Nothing else in the library imports this subpackage.
"""
