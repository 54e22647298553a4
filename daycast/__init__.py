"""daycast: daily time-series analytics and forecasting on Spark.

Every operator takes and returns DataFrames keyed by ``series_id`` so that the
same plan serves one series or millions.  Raw readings are aggregated to days
first (map-side partial aggregation), after which every per-series window is
bounded by the number of days in the calendar, not by the raw row count.
"""

from daycast.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
