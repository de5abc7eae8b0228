"""Registered queries on the given tables, each with its SQL check."""

from catalog.registry import ORACLES, QUERIES
from catalog import grids, indicators, linking, raws, registry_quality, reports, studies, texts  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
