"""Training-data operators (tokenizing, near-duplicates, filters, extraction).

Self-contained: nothing else in the library imports this subpackage.
"""
