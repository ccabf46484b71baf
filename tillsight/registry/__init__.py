"""The named queries: each a Spark job over the given tables, most with an equal SQL statement."""

from .base import ORACLES, QUERIES
from . import checks, cleansing, current, marts, reports, versions  # noqa: F401  (they fill the two tables)
from . import stored  # noqa: F401, E402  (after those whose SQL it shares)

__all__ = ["ORACLES", "QUERIES"]
