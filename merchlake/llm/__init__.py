"""Operators for preparing training text: counting, filtering, deduplicating, sharding and packing."""
