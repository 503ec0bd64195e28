"""Every operator as a query over the given tables."""

from registry import changes, marts, streams, texts, timelines  # noqa: F401
from registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
