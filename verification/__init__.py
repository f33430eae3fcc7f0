"""Checked queries: each Spark query beside an independent SQL statement over the same tables."""

from verification.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "load"]


def load():
    from verification import (  # noqa: F401
        aggregates, indicators, joins, models, projections, quality, scalars, sources, streams, tables, windows,
    )

    return QUERIES, ORACLES
