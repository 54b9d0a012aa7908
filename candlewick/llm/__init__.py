"""Training-data operators: toxicity, near-duplicates, line dedup, packing and the like.

Nothing outside this subpackage imports it; ``registry.py`` holds its named queries.
"""
