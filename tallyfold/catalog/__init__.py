"""Registered queries and their SQL twins."""

from tallyfold.catalog import cleaning, learning, profile, scoring, series, splits, star, storage  # noqa: F401
from tallyfold.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
