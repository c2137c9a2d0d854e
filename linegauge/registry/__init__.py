"""Runnable queries over the parquet tables of a folder."""

from linegauge.registry.base import QUERIES  # noqa: F401


def load_all() -> dict:
    """Import every query module and return the registry."""
    from linegauge.registry import business, cleansing, grouping, integrity, models, relations, scans  # noqa: F401
    from linegauge.registry import profiling, statistics, surveillance  # noqa: F401

    return QUERIES
