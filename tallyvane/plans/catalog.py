"""All registered queries of the library, and the SQL that gives the same rows."""

from tallyvane.plans import aggregates, composites, files, functions, joins, reports, series, streams, workflows  # noqa: F401
from tallyvane.plans.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
