"""Helpers that are shipped to executors as a file; no imports from this package."""

import pandas as pd


def month_digits(texts: pd.Series) -> pd.Series:
    """Month of ``12-JAN-2019`` as two digits."""
    return pd.to_datetime(texts.str.title(), format="%d-%b-%Y").dt.strftime("%m")
