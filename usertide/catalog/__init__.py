"""The registered queries, the input views they read and their SQL twins."""

from usertide.catalog import behaviour, modelling, quality, scoring  # noqa: F401
from usertide.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
