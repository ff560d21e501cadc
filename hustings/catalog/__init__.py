"""Queries over the standard tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from hustings.catalog.registry import QUERIES, SQL

MODULES = ["texts", "tallies", "links", "crosswalks", "kin", "shapes", "audits", "landed", "files",
           "outlines", "pipeline"]


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    for module in MODULES:
        import_module(f"hustings.catalog.{module}")
    return QUERIES, SQL
