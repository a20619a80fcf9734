"""Training-data operators: secrets, token files, quality, mixing, language
ID, passage, line and near-duplicate removal, vector search and packing.

Nothing outside this subpackage imports it.
"""
