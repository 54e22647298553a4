"""Training-data operators: chat formatting, deduplication, quality, secrets, mixing and retrieval.

Nothing outside this subpackage imports it; ``queries.py`` registers one query
per operator.
"""
