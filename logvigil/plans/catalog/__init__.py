"""Every query by name, with oracle SQL where the result can be stated in SQL."""

from . import chain, detect, features, index, metrics, parsing, profile, review, rules, streams  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
