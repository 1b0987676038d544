"""Registered queries; importing this package fills the registry."""

from tickloom.plans import lines, models, pages, rows, scans, series, stores, streams  # noqa: F401
from tickloom.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
