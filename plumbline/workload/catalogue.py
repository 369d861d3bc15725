"""Importing the query modules fills the registry."""

from plumbline.workload import (  # noqa: F401
    conformance, distributions, exceptions, modelling, profiling, storage,
)
from plumbline.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
