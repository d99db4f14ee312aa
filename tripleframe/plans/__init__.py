"""Registered queries; importing this package registers them all."""

from tripleframe.plans import changes, scalars, scans, solutions, walks  # noqa: F401
from tripleframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
