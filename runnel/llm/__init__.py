"""Training-data operators: dedup, formatting, language, extraction, mixing, search, token files, packing.

Nothing outside this subpackage imports it.
"""
