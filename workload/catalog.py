"""All registered queries."""

from workload import groups, intake, rows, serving, streams, tracks  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
