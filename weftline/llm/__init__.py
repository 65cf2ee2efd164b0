"""Training-data operators: extraction, search, mixing, sharding, filtering, deduplication, tokens and language models.

Nothing outside this package imports it.
"""
