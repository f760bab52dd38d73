"""Operators for preparing large text corpora: mixing, sharding, packing, counting, filtering, deduplicating."""
