"""Named queries over the stored tables, each next to the SQL it must agree with."""

from revrank.registry import explore, features, gradients, graphs, lists, metrics, models, rows, sequences, streams  # noqa: F401
from revrank.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
