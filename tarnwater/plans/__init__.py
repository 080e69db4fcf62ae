"""Registered queries over the shared tables, each with its SQL twin where one exists."""

from tarnwater.plans import arrays, candidates, claims, features, logs, models, relational, scalars, sources, splits, statistics, tabular, text  # noqa: F401
from tarnwater.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
