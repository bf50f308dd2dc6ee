"""All registered queries."""

from __future__ import annotations

import importlib

from marketflow.suite.registry import ORACLES, QUERIES

MODULES = (
    "sources", "sinks", "projections", "joins", "aggregations", "windows", "sets", "functions",
    "nested", "streams", "logs", "markets", "cells", "snapshots", "partitions",
)


def load():
    """Import every module of queries; returns (queries, SQL)."""
    for name in MODULES:
        importlib.import_module(f"marketflow.suite.{name}")
    return QUERIES, ORACLES
