"""All queries outside of the optional subpackage, with their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MODULES = ["heavy", "catalogue", "selection", "review", "rules"]


def _all(name: str) -> dict:
    out: dict = {}
    for module in _MODULES:
        own = getattr(importlib.import_module(f"leafmill.plans.{module}"), name)
        if doubled := out.keys() & own.keys():
            raise ValueError(f"queries of one name: {sorted(doubled)}")
        out |= own
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("SQL")
