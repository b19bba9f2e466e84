"""Named reports.  Importing this package registers every report."""

from quarry.plans import basics, grouping, joining, lessons, more_lessons, periods, quality, scaled  # noqa: F401
from quarry.plans.registry import OPS, ORACLE, QUERIES, report

__all__ = ["QUERIES", "ORACLE", "OPS", "report"]
