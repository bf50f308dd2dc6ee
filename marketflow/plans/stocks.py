"""Totals of measures over several combinations of dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.dates import parse_date_lenient

#: The columns of the month-level stock table, dimensions then measures.
MONTH_COLUMNS = ("symbol", "yr", "mnth", "qty", "vlu")
DIMENSIONS, MEASURES = MONTH_COLUMNS[:3], MONTH_COLUMNS[3:]


def with_month(df: DataFrame, date: str = "trdate") -> DataFrame:
    """Year and month of a leniently written date, in the layout of MONTH_COLUMNS."""
    day = parse_date_lenient(F.col(date))
    return df.withColumns({"yr": F.year(day), "mnth": F.month(day)}).select(*MONTH_COLUMNS)


def totals(
    df: DataFrame,
    mode: str,
    dimensions: Sequence[str] = DIMENSIONS,
    measures: Sequence[str] = MEASURES,
    sets: Sequence[Sequence[str]] = (),
    set_id: str | None = None,
) -> DataFrame:
    """Sums of ``measures`` by ``mode``: cube, rollup, or the listed ``sets`` of dimensions.

    ``set_id`` names a column that tells a total's null from a null in the data.
    """
    if mode == "sets":
        groups = df.groupingSets([[F.col(c) for c in s] for s in sets], *dimensions)
    elif mode in ("cube", "rollup"):
        groups = getattr(df, mode)(*dimensions)
    else:
        raise ValueError(mode)
    sums = [F.sum(m).alias(m) for m in measures]
    return groups.agg(*sums, *([F.grouping_id().alias(set_id)] if set_id else []))
