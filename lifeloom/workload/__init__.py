"""Named queries over the driver's tables."""

from lifeloom.workload import cohorts, daily, jobs, people, primitives, sources, streams  # noqa: F401
from lifeloom.workload.base import ORACLES, QUERIES, runner

__all__ = ["ORACLES", "QUERIES", "runner"]
