"""Registered queries, one module per part of the library."""

from queries import (  # noqa: F401
    anomaly, columns, evaluation, experiments, grids, joins, learning, prepare, sampling, scans, statistics,
)
from queries.registry import ORACLES, QUERIES  # noqa: F401
