"""Training-data operators (LM scoring, tokenisation, search, deduplication, packing, quality).

Nothing else in the library imports this subpackage.
"""
