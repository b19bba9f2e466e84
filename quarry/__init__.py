"""quarry: business-analytics operators and named reports on Spark DataFrames.

Sub-packages
------------
sources    load tables with explicit schemas, register views, CSV export
functions  column-level helpers: predicates, labels/binning, time parts, ratios
operators  DataFrame-level building blocks: joins, aggregations, ranking, profiles
plans      the named reports (one function per query) and their SQL oracles
"""

from quarry.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
