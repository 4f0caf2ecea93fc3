"""Imports every query module so that the registry is complete."""

from quarry.plans import q_collect, q_evaluate, q_filter, q_io, q_prepare, q_runs  # noqa: F401
from quarry.plans.registry import QUERIES  # noqa: F401
