"""Training-data operators: tokenised output, packing, dedup, filters, scoring and sharding.

Nothing outside this subpackage imports it.
"""
