"""Queries over the given tables, each with the SQL it must agree with."""

from workload import columns, filters, jobs, joins, latest, quality, sources, spells  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
