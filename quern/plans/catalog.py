"""Imports every module that registers queries."""

from quern.plans import (  # noqa: F401
    measurement,
    modelling,
    relational,
    storage,
    streams,
    transactions,
)
from quern.plans.registry import ENTRIES

__all__ = ["ENTRIES"]
