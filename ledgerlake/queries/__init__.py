"""Registered queries over the given tables. Importing a module registers its queries."""

from . import corpus, history, layers, retrieval, upkeep, versions
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "corpus", "history", "layers", "retrieval", "upkeep", "versions"]
