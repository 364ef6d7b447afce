"""Each operator on the shared test tables, with the same question in plain SQL beside it."""

from trackfuse.queries import columns, joins, jobs, learning, messages, sinks, streams  # noqa: F401
from trackfuse.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
