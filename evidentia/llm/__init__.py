"""Training-data operators: dedup, filtering, search, sharding, mixing and tokenisation over the corpus tables.

Nothing outside this package imports it.
"""
