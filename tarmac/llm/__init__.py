"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from tarmac.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
