"""Named queries; importing the package fills the registry."""

from usagelake.catalog import audits, business, feeds, jobs, operators, reporting, tables  # noqa: F401
from usagelake.catalog.registry import ORACLES, QUERIES, Tables, query

__all__ = ["ORACLES", "QUERIES", "Tables", "query"]
