"""Text fields and composite keys as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketflow.functions.dates import epoch_seconds, month_number


def csv_field(col, i: int, sep: str = ",") -> Column:
    """Item ``i`` of a delimited line, null when the line is shorter."""
    return F.get(F.split(col, sep), F.lit(i))


def words(col, sep: str = " ") -> Column:
    """Array of the separated words; explode it for one row per word."""
    return F.split(col, sep)


def word_counts(col, sep: str = " ") -> Column:
    """Array of (word, n): each separated word once, with its count in this value; null for null.

    The words are sorted, so that equal ones are neighbours; an array of one element, transformed,
    gives its expression a name, or it would be computed for every word.
    """

    def of_sorted(s: Column) -> Column:
        size = F.size(s)
        ends = F.filter(F.sequence(F.lit(1), size), lambda i: (i == size) | (F.get(s, i - 1) != F.get(s, i)))
        return F.transform(F.array(ends), lambda e: F.transform(e, lambda x, i: run(s, e, x, i)))[0]

    def run(s: Column, e: Column, x: Column, i: Column) -> Column:
        before = F.coalesce(F.get(e, i - 1), F.lit(0))
        return F.struct(F.get(s, x - 1).alias("word"), (x - before).cast("long").alias("n"))

    return F.when(col.isNotNull(), F.transform(F.array(F.sort_array(words(col, sep))), of_sorted)[0])


def join_fields(*cols, sep: str = ",") -> Column:
    """Fields joined as one line; null when any field is null."""
    parts = []
    for c in cols:
        parts += [F.lit(sep), (F.col(c) if isinstance(c, str) else c).cast("string")]
    return F.concat(*parts[1:])


def regex_groups(col, pattern: str, n: int) -> list[Column]:
    """The ``n`` groups of ``pattern``; empty strings when the line does not match."""
    return [F.regexp_extract(col, pattern, i) for i in range(1, n + 1)]


def contract_row_key(symbol, expiry, option_type, strike, trade) -> Column:
    """``s<symbol>e<expiry epoch>o<type>p<strike>t<trade epoch>``."""
    return F.concat(
        F.lit("s"), symbol,
        F.lit("e"), epoch_seconds(expiry).cast("string"),
        F.lit("o"), option_type,
        F.lit("p"), F.col(strike).cast("string") if isinstance(strike, str) else strike.cast("string"),
        F.lit("t"), epoch_seconds(trade).cast("string"),
    )


def day_symbol_key(day, symbol, series, pad: bool = True) -> Column:
    """``yyyy-mm-dd`` + symbol + ``s`` + series from a ``dd-MON-yyyy`` day."""
    iso = F.concat(
        F.substring(day, -4, 4), F.lit("-"),
        month_number(F.substring(day, 4, 3), pad), F.lit("-"),
        F.substring(day, 0, 2),
    )
    return F.concat(iso, symbol, F.lit("s"), series)
