"""Training-data operators: dedup, decontamination, scoring, tokenization, sharding.

Nothing else in the library imports this subpackage.
"""
