"""All registered queries and their oracles."""

from checks import (  # noqa: F401
    aggregates,
    expressions,
    functions,
    jobs,
    joins,
    learning,
    scans,
    sinks,
    windows,
)
from checks.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
