"""Dates, times and month names as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three-letter month names used in exchange files.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]


def trade_date(col) -> Column:
    """Date of a ``12-JAN-2019`` / ``26-Apr-2018`` string; an unknown month raises (ANSI)."""
    return F.to_date(col, "d-MMM-yyyy")


def try_trade_date(col) -> Column:
    """As :func:`trade_date`, but null for text that is not a date."""
    return F.try_to_date(col, "d-MMM-yyyy")


def month_name_to_number(col) -> Column:
    """``12-JAN-2019`` -> ``12-01-2019``."""
    return F.date_format(trade_date(col), "dd-MM-yyyy")


def month_number(col, pad: bool = True) -> Column:
    """Number of a three-letter month name as text, null for other text.

    ``pad=False`` drops the leading zero, as numeric CASE branches joined into a key would.
    """
    name = F.upper(col)
    branches = None
    for i, month in enumerate(MONTHS, 1):
        text = F.lit(f"{i:02d}" if pad else str(i))
        branches = (F.when if branches is None else branches.when)(name == month, text)
    return branches


def parse_ts(col, fmt: str = "dd-MM-yyyy") -> Column:
    return F.to_timestamp(col, fmt)


def parse_date_lenient(col) -> Column:
    """ISO date whose month or day may lack the leading zero (``2017-5-02``)."""
    return F.to_date(col)


def day_of_year(col) -> Column:
    """1..366.  Market tables store this in a column called DAY."""
    return F.dayofyear(col)


def parse_apache_time(col) -> Column:
    """``01/Aug/1995:00:00:01 -0400`` -> local timestamp; the zone is ignored, bad text is null."""
    return F.try_to_timestamp(F.substring(col, 1, 20), F.lit("dd/MMM/yyyy:HH:mm:ss"))


def epoch_seconds(col) -> Column:
    """Seconds since 1970-01-01 in the session time zone (UTC by default here)."""
    return F.unix_timestamp(F.to_timestamp(col))


def contract_expiry(col, weekday: str = "THU", cutoff: int = 21) -> Column:
    """Last ``weekday`` of the trade month; from day ``cutoff`` on, of the following month."""
    month = F.when(F.dayofmonth(col) < cutoff, col).otherwise(F.add_months(col, 1))
    return F.next_day(F.date_sub(F.last_day(month), 7), weekday)


def format_dmy(col) -> Column:
    """``7-JAN-2021``."""
    return F.upper(F.date_format(col, "d-MMM-yyyy"))


def iso_date(col, fmt: str = "dd-MM-yyyy") -> Column:
    """``12-01-2019`` -> ``2019-01-12``."""
    return F.date_format(F.to_date(col, fmt), "yyyy-MM-dd")


def file_date(path_col, pattern: str = r"(\d{2}[A-Z]{3}\d{4})bhav") -> Column:
    """Processing date carried by a file name such as ``fo01JUN2023bhav.csv.gz``."""
    return F.try_to_date(F.regexp_extract(path_col, pattern, 1), "ddMMMyyyy")
