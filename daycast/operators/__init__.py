"""Relational operators of the engine, all keyed by ``series_id``."""
