"""Scan filters on resolved cells (row, family, qualifier, ts, value).

Each function returns a ``DataFrame -> DataFrame`` step; a list of steps applied in turn is their
conjunction.  Steps that look at a whole row use joins and top-n, never a row's cells in memory; they
store the cells first, so that resolving versions is done once.  :func:`compiled` makes steps of
a filter string.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.operators.windows import top_per_key
from marketflow.session import stored

Step = Callable[[DataFrame], DataFrame]
IN_ROW = ("family", "qualifier")
COMPARE = {
    "=": operator.eq, "!=": operator.ne, "<": operator.lt,
    "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}


def matches(col: str, op: str, comparator: str) -> Column:
    """Test ``col`` against ``binary:x``, ``substring:x`` or ``regexstring:x``.

    Substring (case-insensitive) and regex tests know only ``=`` and ``!=``.
    """
    kind, _, text = comparator.partition(":")
    if kind == "binary":
        return COMPARE[op](F.col(col), F.lit(text))
    if kind == "substring":
        found = F.contains(F.lower(F.col(col)), F.lit(text.lower()))
    elif kind == "regexstring":
        found = F.col(col).rlike(text)
    else:
        raise ValueError(f"unknown comparator {comparator!r}")
    if op not in ("=", "!="):
        raise ValueError(f"{kind} comparator cannot be used with {op}")
    return found if op == "=" else ~found


def where(condition: Column) -> Step:
    return lambda cells: cells.filter(condition)


def row_filter(op: str, comparator: str) -> Step:
    return where(matches("row", op, comparator))


def family_filter(op: str, comparator: str) -> Step:
    return where(matches("family", op, comparator))


def qualifier_filter(op: str, comparator: str) -> Step:
    return where(matches("qualifier", op, comparator))


def value_filter(op: str, comparator: str) -> Step:
    return where(matches("value", op, comparator))


def key_only() -> Step:
    return lambda cells: cells.withColumn("value", F.lit(""))


def first_key_only() -> Step:
    return column_count(1)


def prefix(text: str) -> Step:
    return where(F.col("row").startswith(text))


def column_prefix(*prefixes: str) -> Step:
    keep = F.lit(False)
    for p in prefixes:
        keep = keep | F.col("qualifier").startswith(p)
    return where(keep)


def column_range(low: str, low_included: bool, high: str, high_included: bool) -> Step:
    q = F.col("qualifier")
    return where((q >= low if low_included else q > low) & (q <= high if high_included else q < high))


def column_count(n: int) -> Step:
    """The first ``n`` cells of each row in column order."""
    return column_page(n, 0)


def column_page(limit: int, offset: int) -> Step:
    """``limit`` cells of each row after skipping ``offset``."""
    order = [F.col("family"), F.col("qualifier"), F.desc("ts")]
    return lambda cells: top_per_key(cells, ["row"], order, offset + limit, skip=offset)


def page(n: int) -> Step:
    """All cells of the first ``n`` rows of the scan."""

    def step(cells: DataFrame) -> DataFrame:
        cells = stored(cells, "cells")
        first = cells.select("row").distinct().orderBy("row").limit(n)
        return cells.join(first, "row", "left_semi")

    return step


def inclusive_stop(row: str) -> Step:
    return where(F.col("row") <= row)


def timestamps(values: Sequence[int]) -> Step:
    return where(F.col("ts").isin(list(values)))


def dependent_column(family: str, qualifier: str) -> Step:
    """Cells with the timestamp of the row's given column; a row without it gives nothing."""

    def step(cells: DataFrame) -> DataFrame:
        cells = stored(cells, "cells")
        anchor = cells.filter((F.col("family") == family) & (F.col("qualifier") == qualifier))
        return cells.join(anchor.select("row", "ts"), ["row", "ts"], "left_semi")

    return step


def single_column_value(
    family: str, qualifier: str, op: str, comparator: str, exclude: bool = False
) -> Step:
    """Whole rows whose given column passes or is missing; ``exclude`` drops that column after."""

    def step(cells: DataFrame) -> DataFrame:
        cells = stored(cells, "cells")
        tested = (F.col("family") == family) & (F.col("qualifier") == qualifier)
        failing = cells.filter(tested & ~matches("value", op, comparator)).select("row")
        kept = cells.join(failing, "row", "left_anti")
        return kept.filter(~tested) if exclude else kept

    return step


def skip(condition: Column) -> Step:
    """Drop a whole row when any of its cells fails the condition."""

    def step(cells: DataFrame) -> DataFrame:
        cells = stored(cells, "cells")
        failing = cells.filter(~F.coalesce(condition, F.lit(False))).select("row").distinct()
        return cells.join(failing, "row", "left_anti")

    return step


def while_(condition: Column, scope: str = "scan") -> Step:
    """Emit until the first cell that fails.

    ``scan`` stops the whole scan there; ``row`` stops only that row.
    """
    fails = ~F.coalesce(condition, F.lit(False))
    at = F.struct("row", *IN_ROW)

    def whole(cells: DataFrame) -> DataFrame:
        cells = stored(cells, "cells")
        first = cells.filter(fails).agg(F.min(at).alias("at")).select("at").scalar()
        # Without a failing cell the comparison is null and everything stays.
        return cells.filter(F.coalesce(at < first, F.lit(True)))

    def per_row(cells: DataFrame) -> DataFrame:
        cells = stored(cells, "cells")
        first = cells.filter(fails).groupBy("row").agg(F.min(F.struct(*IN_ROW)).alias("_stop"))
        joined = cells.join(first, "row", "left")
        return joined.filter(F.col("_stop").isNull() | (F.struct(*IN_ROW) < F.col("_stop"))).drop("_stop")

    if scope not in ("scan", "row"):
        raise ValueError(scope)
    return whole if scope == "scan" else per_row


# --- filter strings ------------------------------------------------------------------------------

#: Tests of one cell, which SKIP and WHILE may stand before: name -> tested column.
TESTED = {"RowFilter": "row", "FamilyFilter": "family", "QualifierFilter": "qualifier", "ValueFilter": "value"}

STEPS: dict[str, Callable[..., Step]] = {
    "KeyOnlyFilter": key_only,
    "FirstKeyOnlyFilter": first_key_only,
    "ColumnPrefixFilter": column_prefix,
    "MultipleColumnPrefixFilter": column_prefix,
    "ColumnCountGetFilter": column_count,
    "PageFilter": page,
    "ColumnPaginationFilter": column_page,
    "InclusiveStopFilter": inclusive_stop,
    "PrefixFilter": prefix,
    "TimestampsFilter": lambda *values: timestamps(values),
    "DependentColumnFilter": dependent_column,
    "SingleColumnValueFilter": single_column_value,
    "SingleColumnValueExcludeFilter": lambda *args: single_column_value(*args, exclude=True),
    "ColumnRangeFilter": column_range,
    **{name: (lambda op, test, c=column: where(matches(c, op, test))) for name, column in TESTED.items()},
}

_QUOTED = r"'(?:[^']|'')*'"
_ONE = re.compile(rf"\s*(?:(SKIP|WHILE)\s+)?(\w+)\s*\(((?:[^()']|{_QUOTED})*)\)\s*")
_ARGUMENT = re.compile(rf"\s*({_QUOTED}|[^,']+?)\s*(?:,|$)")


def _arguments(text: str) -> list:
    """Quoted texts (a quote inside is doubled), whole numbers, true and false, comparison signs."""
    out, at = [], 0
    while text[at:].strip():
        m = _ARGUMENT.match(text, at)
        if m is None:
            raise ValueError(f"cannot read the arguments {text!r}")
        raw, at = m[1], m.end()
        if raw.startswith("'"):
            out.append(raw[1:-1].replace("''", "'"))
        elif raw.lstrip("-").isdigit():
            out.append(int(raw))
        elif raw in ("true", "false"):
            out.append(raw == "true")
        elif raw in COMPARE:
            out.append(raw)
        else:
            raise ValueError(f"cannot read the argument {raw!r}")
    return out


def compiled(text: str) -> list[Step]:
    """The steps of a filter string: filters joined by AND, each with SKIP or WHILE before it if wanted.

    ``PrefixFilter('row-7') AND SKIP ValueFilter(!=, 'binary:x')``.  SKIP and WHILE take tests of one
    cell.  Unknown names, OR and anything else that cannot be read are refused.
    """
    steps, at = [], 0
    while True:
        m = _ONE.match(text, at)
        if m is None:
            raise ValueError(f"no filter at {text[at:]!r}")
        word, name, arguments = m[1], m[2], _arguments(m[3])
        if name not in STEPS:
            raise ValueError(f"unknown filter {name!r}")
        if word is None:
            steps.append(STEPS[name](*arguments))
        elif name in TESTED:
            steps.append((skip if word == "SKIP" else while_)(matches(TESTED[name], *arguments)))
        else:
            raise ValueError(f"{word} cannot stand before {name}")
        at = m.end()
        if at == len(text):
            return steps
        if not re.match(r"AND\b", text[at:]):
            raise ValueError(f"expected AND at {text[at:]!r}")
        at += 3
