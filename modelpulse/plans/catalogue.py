"""All registered queries."""

from modelpulse.plans import data_ops, inference, learning, logs, search, serving, streams  # noqa: F401
from modelpulse.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
