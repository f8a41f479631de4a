"""Imports every module that registers queries."""

from tallymill.plans import (  # noqa: F401
    activity,
    basics,
    commerce,
    forecasting,
    incidents,
    learning,
    retail,
    storage,
    survey,
    titles,
)
from tallymill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
