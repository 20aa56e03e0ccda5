"""All registered queries: importing the modules registers them."""

from __future__ import annotations

from bloomline.plans import (  # noqa: F401
    queries_cleaning, queries_jobs, queries_marts, queries_quality, queries_serving, queries_statements,
)
from bloomline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
