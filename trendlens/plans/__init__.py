"""Registered queries. Importing this package registers all of them."""

from trendlens.plans import catalog, datasets, evaluation, operations, streams  # noqa: F401
from trendlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
