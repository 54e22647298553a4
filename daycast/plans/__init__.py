"""Composed plans: the pipeline stages, the query catalog and its SQL oracle."""
