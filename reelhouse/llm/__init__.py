"""Operators for preparing training text: search, packing, sharding, filtering, tokens."""
