"""End-of-day derivatives and cash-market reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions.dates import trade_date
from marketflow.functions.numbers import lot_size, safe_divide
from marketflow.operators.aggregates import pivot_sum, price_band
from marketflow.operators.windows import lagged, moving_avg, running_sum

# Futures carry XX, puts PE, calls CE.
OPTION_TYPES = ["XX", "PE", "CE"]
GROUP_KEYS = ["rts", "SYMBOL", "INSTRUMENT", "EXPIRY_DT", "OPTION_TYP", "YEAR", "MONTH", "DAY"]
PCR_KEYS = ["rts", "SYMBOL", "EXPIRY_DT", "YEAR", "MONTH", "DAY"]
CONTRACT = ["SYMBOL", "EXPIRY_DT", "INSTRUMENT"]
# The processed table's columns.
PROCESSED = [
    "rts", "SYMBOL", "EXPIRY_DT", "INSTRUMENT", "OPTION_TYP", "CONTRACTS", "VALUE", "OPEN_INT", "PCR",
    "YEAR", "MONTH", "DAY",
]


def drop_phantom(df: DataFrame) -> DataFrame:
    """Without the empty last column that a trailing comma makes in these files."""
    return df.drop("_c13", "_c15")


def with_trade_date(df: DataFrame) -> DataFrame:
    """Add rts, YEAR, MONTH and DAY (day of the year) from TIMESTAMP."""
    day = trade_date(F.col("TIMESTAMP"))
    return drop_phantom(df).withColumns(
        {
            "rts": F.to_timestamp(day),
            "YEAR": F.year(day),
            "MONTH": F.month(day),
            "DAY": F.dayofyear(day),
        }
    )


#: Daily totals by output name, and the column each adds up (fixed values of the file format).
DAILY_TOTALS = {"CONTRACTS": "CONTRACTS", "VALUE": "VAL_INLAKH", "OPEN_INT": "OPEN_INT"}


def group_instruments(df: DataFrame, derive: bool = True) -> DataFrame:
    """Daily totals per contract line; ``derive=False`` when YEAR, MONTH and DAY are present."""
    dated = with_trade_date(df)
    if not derive:
        dated = drop_phantom(df).withColumn("rts", F.to_timestamp(trade_date(F.col("TIMESTAMP"))))
    return dated.groupBy(*GROUP_KEYS).agg(*[F.sum(source).alias(name) for name, source in DAILY_TOTALS.items()])


def _counts_for_pcr() -> Column:
    """Stock futures are left out of the ratio; index futures stay, as XX."""
    return F.col("INSTRUMENT") != "FUTSTK"


def pcr_by_contracts(grouped: DataFrame) -> DataFrame:
    """Put-call ratio of traded contracts by symbol, expiry and day."""
    wide = pivot_sum(grouped.filter(_counts_for_pcr()), PCR_KEYS, "OPTION_TYP", OPTION_TYPES, "CONTRACTS")
    return wide.withColumn("pcr", safe_divide(F.col("PE"), F.col("CE")))


def with_pcr(grouped: DataFrame) -> DataFrame:
    """Grouped rows with PE, CE and PCR of their symbol, expiry and day.

    A group holds the few instrument and option types of one contract, so the ratio is a window over
    the grouped rows: they are made once and shuffled once more.  Rows whose group has nothing to count
    for the ratio, or whose key is null, disappear, as they would in an inner join.
    """
    together = Window.partitionBy("rts", "SYMBOL", "EXPIRY_DT")

    def total(kind: str) -> Column:
        return F.sum(F.when(_counts_for_pcr() & (F.col("OPTION_TYP") == kind), F.col("CONTRACTS"))).over(together)

    counted = grouped.dropna(subset=["rts", "SYMBOL", "EXPIRY_DT"]).withColumns(
        {"PE": total("PE"), "CE": total("CE"), "_counted": F.count_if(_counts_for_pcr()).over(together)}
    )
    return counted.filter("_counted > 0").drop("_counted").withColumn("PCR", safe_divide(F.col("PE"), F.col("CE")))


def pcr_by_open_interest(df: DataFrame) -> DataFrame:
    """Put-call ratio of open interest, for contracts that have both calls and puts.

    Both totals come from one aggregate; requiring a row of each kind equals the inner join of the
    two filtered totals without its extra shuffle.
    """
    is_call, is_put = F.col("OPTION_TYP") == "CE", F.col("OPTION_TYP") == "PE"
    return (
        df.filter(F.col("OPTION_TYP").isin("CE", "PE"))
        .groupBy("SYMBOL", "EXPIRY_DT", "TIMESTAMP")
        .agg(
            F.sum(F.when(is_call, F.col("OPEN_INT"))).alias("totce"),
            F.sum(F.when(is_put, F.col("OPEN_INT"))).alias("totpe"),
            F.count_if(is_call).alias("_calls"),
            F.count_if(is_put).alias("_puts"),
        )
        .filter("_calls > 0 and _puts > 0")
        .drop("_calls", "_puts")
        .withColumn("pcr", safe_divide(F.col("totpe"), F.col("totce")))
    )


def process_day_files(df: DataFrame) -> DataFrame:
    """Raw rows to the processed table: normalise, group, add PCR."""
    return with_pcr(group_instruments(df)).select(*PROCESSED)


def _futures_status(futures: DataFrame, **tuning) -> DataFrame:
    dated = futures.withColumn("tsp", trade_date(F.col("TIMESTAMP")))
    change = F.col("CHG_IN_OI")
    return running_sum(
        dated,
        CONTRACT,
        ["tsp"],
        {"cum_chg_oi": change, "b_s_pl_status": change * F.col("CLOSE")},
        **tuning,
    )


def pl_status(df: DataFrame, symbol: str | None = None, expiry: str | None = None, **tuning) -> DataFrame:
    """Running change in open interest, and its value, per futures contract by trade date.

    Rows of one date are summed together (default RANGE frame).  Filters on the contract columns
    are applied before the window, which leaves the running sums unchanged.
    """
    rows = df.filter(F.col("INSTRUMENT").startswith("FUT"))
    if symbol is not None:
        rows = rows.filter(F.col("SYMBOL") == symbol)
    if expiry is not None:
        rows = rows.filter(F.col("EXPIRY_DT") == expiry)
    return _futures_status(rows, **tuning).select(
        "TIMESTAMP", "tsp", "INSTRUMENT", "SYMBOL", "EXPIRY_DT", "CHG_IN_OI", "CLOSE", "OPEN_INT",
        "cum_chg_oi", "b_s_pl_status",
    )


def final_pl(df: DataFrame, symbol: str | None = None, **tuning) -> DataFrame:
    """Status on expiry day less the value of the open interest; negative means buyers won."""
    status = pl_status(df, symbol, **tuning)
    return status.filter(F.upper("EXPIRY_DT") == F.col("TIMESTAMP")).withColumn(
        "fpl_status", F.col("b_s_pl_status") - F.col("OPEN_INT") * F.col("CLOSE")
    )


def moving_averages(df: DataFrame, order: list[str], windows=(5, 20, 50, 200), **tuning) -> DataFrame:
    """``mv{n}avg`` of CLOSE over the row and the n before it, per symbol."""
    return moving_avg(df, ["SYMBOL"], order, "CLOSE", {f"mv{n}avg": n for n in windows}, **tuning)


def sequence_prices(df: DataFrame, order: list[str], steps=(5, 10, 15, 20), **tuning) -> DataFrame:
    """Row number per symbol and the CLOSE 5, 10, 15 and 20 rows earlier."""
    return lagged(df, ["SYMBOL"], order, "CLOSE", steps, number="rno", **tuning)


def lot_sizes(df: DataFrame) -> DataFrame:
    """Lot size for every futures price band."""
    bands = price_band(df).filter(F.col("INSTRUMENT").startswith("FUT"))
    return bands.withColumn("lotsize", lot_size(F.col("mncls")))


def with_lot_size(df: DataFrame) -> DataFrame:
    """Every price band with the lot sizes of its symbol.

    A symbol with several futures bands repeats its rows once per band.  Repeats are what a join
    on the symbol gives, so they are kept.
    """
    return price_band(df).join(lot_sizes(df).select("SYMBOL", "lotsize"), "SYMBOL")


def reshape_bhav(df: DataFrame) -> DataFrame:
    """Loader layout: key columns first and both dates in ISO form."""
    return df.select(
        F.col("SYMBOL").alias("symbol"),
        F.date_format(trade_date(F.col("EXPIRY_DT")), "yyyy-MM-dd").alias("expiry"),
        F.col("OPTION_TYP").alias("optiontype"),
        F.col("STRIKE_PR").alias("strikeprice"),
        F.date_format(trade_date(F.col("TIMESTAMP")), "yyyy-MM-dd").alias("tradedate"),
        F.col("INSTRUMENT").alias("instrument"),
        *[F.col(c).alias(c.lower()) for c in ("OPEN", "HIGH", "LOW", "CLOSE", "SETTLE_PR")],
        F.col("CONTRACTS").alias("contracts"),
        F.col("VAL_INLAKH").alias("val"),
        F.col("OPEN_INT").alias("openint"),
        F.col("CHG_IN_OI").alias("chginoi"),
    )


def oi_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("SYMBOL", "EXPIRY_DT", "INSTRUMENT", "OPTION_TYP").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("OPEN_INT").alias("sum_oi"),
        F.sum("VAL_INLAKH").alias("sum_value"),
    )
