"""Scalar column helpers encoding the engine's NULL rules.

N1  NaN becomes NULL once, at ingest.
N2  clipping keeps NULL (bare ``greatest(NULL, 0)`` would give 0).
N6  ratios are NULL when the denominator is 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Degree-day base temperatures (Celsius).
HEATING_BASE = 18.0
COOLING_BASE = 22.0


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL (pandas has a single notion of 'missing')."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def clip_lower(c, lower: float = 0.0) -> Column:
    """``max(x, lower)`` that keeps NULL as NULL."""
    c = col_(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(float(lower))))


def heating_degree_days(temp, base: float = HEATING_BASE) -> Column:
    """``max(base - t, 0)``, NULL when the temperature is missing."""
    return clip_lower(F.lit(float(base)) - col_(temp))


def cooling_degree_days(temp, base: float = COOLING_BASE) -> Column:
    """``max(t - base, 0)``, NULL when the temperature is missing."""
    return clip_lower(col_(temp) - F.lit(float(base)))


def rounded(c, places: int) -> Column:
    """Round and normalise -0.0 to 0.0 (stable text form across engines)."""
    return F.round(col_(c), places) + F.lit(0.0)
