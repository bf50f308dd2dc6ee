"""Arrow functions on executors, with this package sent along."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketflow.session import ship_module

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="marketflow-package-"), "marketflow-package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("marketflow", os.path.relpath(full, top)))
    ship_module(spark, path)
    _shipped.add(app)


def arrow_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` for a function of this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    name, taken = base, {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
