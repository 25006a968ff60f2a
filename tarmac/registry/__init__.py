"""All registered queries, by importing the modules that register them."""

from tarmac.registry import core, ledgers, models, reports, retrieval, streams  # noqa: F401
from tarmac.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
