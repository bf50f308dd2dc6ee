"""Derivatives and cash-market reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.functions.dates import trade_date
from marketflow.functions.numbers import market_direction
from marketflow.operators.collections import upsert
from marketflow.plans import derivatives as M
from marketflow.session import scratch_path
from marketflow.sources.sinks import fresh_table, write_parquet, write_table
from marketflow.suite.derived import CM, FO, cm_bhav, fo_bhav
from marketflow.suite.registry import query

GROUPED = f"""
{FO},
g AS (SELECT tdate::TIMESTAMP AS rts, SYMBOL, INSTRUMENT, EXPIRY_DT, OPTION_TYP, year(tdate)::INTEGER AS YEAR,
    month(tdate)::INTEGER AS MONTH, dayofyear(tdate)::INTEGER AS DAY, sum(CONTRACTS)::BIGINT AS CONTRACTS,
    sum(VAL_INLAKH) AS VALUE, sum(OPEN_INT)::BIGINT AS OPEN_INT FROM fo GROUP BY ALL),
p AS (SELECT rts, SYMBOL, EXPIRY_DT, YEAR, MONTH, DAY, sum(CONTRACTS) FILTER (OPTION_TYP = 'XX')::BIGINT AS XX,
    sum(CONTRACTS) FILTER (OPTION_TYP = 'PE')::BIGINT AS PE, sum(CONTRACTS) FILTER (OPTION_TYP = 'CE')::BIGINT AS CE,
    PE / CE AS pcr FROM g WHERE INSTRUMENT <> 'FUTSTK' GROUP BY ALL)
"""


def _flat(df):
    """Comparable with the SQL side: zone-free times and rounded sums."""
    if "rts" in df.columns:
        df = df.withColumn("rts", F.col("rts").cast("timestamp_ntz"))
    if "VALUE" in df.columns:
        df = df.withColumn("VALUE", F.round("VALUE", 2))
    return df


@query(
    "mkt_01_with_trade_date",
    f"WITH {FO} SELECT TRADE_ID, SYMBOL, OPEN_INT, tdate::TIMESTAMP AS rts, year(tdate)::INTEGER AS \"YEAR\", "
    "month(tdate)::INTEGER AS \"MONTH\", dayofyear(tdate)::INTEGER AS \"DAY\" FROM fo",
)
def _(t):
    return _flat(M.with_trade_date(fo_bhav(t))).select("TRADE_ID", "SYMBOL", "OPEN_INT", "rts", "YEAR", "MONTH", "DAY")


@query("mkt_02_group_instruments", f"WITH {GROUPED} SELECT * REPLACE (round(VALUE, 2) AS VALUE) FROM g")
def _(t):
    return _flat(M.group_instruments(fo_bhav(t)))


@query("mkt_03_group_instruments_given_days", f"WITH {GROUPED} SELECT * REPLACE (round(VALUE, 2) AS VALUE) FROM g")
def _(t):
    dated = M.with_trade_date(fo_bhav(t)).drop("rts")
    return _flat(M.group_instruments(dated, derive=False))


@query("mkt_04_pcr_by_contracts", f"WITH {GROUPED} SELECT * REPLACE (round(pcr, 6) AS pcr) FROM p")
def _(t):
    pcr = M.pcr_by_contracts(M.group_instruments(fo_bhav(t)))
    return _flat(pcr).withColumn("pcr", F.round("pcr", 6))


@query(
    "mkt_05_pcr_by_open_interest",
    f"WITH {FO}, c AS (SELECT SYMBOL, EXPIRY_DT, TIMESTAMP, sum(OPEN_INT)::BIGINT AS totce FROM fo WHERE OPTION_TYP = 'CE' "
    "GROUP BY ALL), p AS (SELECT SYMBOL, EXPIRY_DT, TIMESTAMP, sum(OPEN_INT)::BIGINT AS totpe FROM fo WHERE "
    "OPTION_TYP = 'PE' GROUP BY ALL) SELECT SYMBOL, EXPIRY_DT, TIMESTAMP, totce, totpe, "
    "round(totpe / nullif(totce, 0), 6) AS pcr FROM c JOIN p USING (SYMBOL, EXPIRY_DT, TIMESTAMP)",
)
def _(t):
    return M.pcr_by_open_interest(fo_bhav(t)).withColumn("pcr", F.round("pcr", 6))


@query(
    "mkt_06_market_direction",
    f"WITH {GROUPED}, r AS (SELECT rts, SYMBOL, EXPIRY_DT, round(pcr, 6) AS pcr FROM p) "
    "SELECT rts, SYMBOL, EXPIRY_DT, pcr, CASE WHEN pcr > 1.2 THEN 'extreme bullish' WHEN pcr > 0.8 THEN 'bullish' "
    "WHEN pcr < 0.6 THEN 'extreme bearish' WHEN pcr < 0.8 THEN 'bearish' WHEN pcr = 0.8 THEN 'neutral' END AS direction FROM r",
)
def _(t):
    pcr = _flat(M.pcr_by_contracts(M.group_instruments(fo_bhav(t))))
    rounded = pcr.select("rts", "SYMBOL", "EXPIRY_DT", F.round("pcr", 6).alias("pcr"))
    return rounded.withColumn("direction", market_direction(F.col("pcr")))


@query(
    "mkt_07_combine_grouped_and_pcr",
    f"WITH {GROUPED} SELECT rts, SYMBOL, EXPIRY_DT, INSTRUMENT, OPTION_TYP, CONTRACTS, round(VALUE, 2) AS VALUE, OPEN_INT, "
    'round(pcr, 6) AS "PCR", g.YEAR AS "YEAR", g.MONTH AS "MONTH", g.DAY AS "DAY" FROM g JOIN p USING (rts, SYMBOL, EXPIRY_DT)',
)
def _(t):
    return _flat(M.process_day_files(fo_bhav(t))).withColumn("PCR", F.round("PCR", 6))


@query(
    "jn_17_three_key_join",
    f"WITH {GROUPED} SELECT rts, SYMBOL, EXPIRY_DT, INSTRUMENT, OPTION_TYP, g.CONTRACTS AS CONTRACTS, p.PE AS PE, "
    'g."YEAR" AS "YEAR" FROM g JOIN p USING (rts, SYMBOL, EXPIRY_DT)',
)
def _(t):
    grouped = M.group_instruments(fo_bhav(t))
    pcr = M.pcr_by_contracts(grouped)
    joined = grouped.alias("g").join(pcr.alias("p"), ["rts", "SYMBOL", "EXPIRY_DT"])
    return _flat(
        joined.select("rts", "SYMBOL", "EXPIRY_DT", "INSTRUMENT", "OPTION_TYP", "CONTRACTS", "PE", "g.YEAR")
    )


@query("ud_05_composed_helpers", f"WITH {GROUPED} SELECT SYMBOL, sum(PE)::BIGINT AS puts, sum(CE)::BIGINT AS calls FROM p GROUP BY 1")
def _(t):
    pcr = fo_bhav(t).transform(M.group_instruments).transform(M.pcr_by_contracts)
    return pcr.groupBy("SYMBOL").agg(F.sum("PE").alias("puts"), F.sum("CE").alias("calls"))


PL = f"""
{FO},
pl AS (SELECT TIMESTAMP, tdate AS tsp, edate, INSTRUMENT, SYMBOL, EXPIRY_DT, CHG_IN_OI, CLOSE, OPEN_INT,
    sum(CHG_IN_OI) OVER w AS cum_chg_oi, sum(CHG_IN_OI * CLOSE) OVER w AS b_s_pl_status
  FROM fo WHERE INSTRUMENT LIKE 'FUT%' WINDOW w AS (PARTITION BY SYMBOL, EXPIRY_DT, INSTRUMENT ORDER BY tdate))
"""
_PL = (
    "TIMESTAMP, tsp, INSTRUMENT, SYMBOL, EXPIRY_DT, CHG_IN_OI, CLOSE, OPEN_INT, cum_chg_oi::BIGINT AS cum_chg_oi, "
    "round(b_s_pl_status, 2) AS b_s_pl_status"
)


@query("mkt_08_pl_status_all", f"WITH {PL} SELECT {_PL} FROM pl")
def _(t):
    return M.pl_status(fo_bhav(t)).withColumn("b_s_pl_status", F.round("b_s_pl_status", 2))


@query("mkt_08_pl_status", f"WITH {PL} SELECT {_PL} FROM pl WHERE SYMBOL = 'SYM3' AND EXPIRY_DT = '30-Apr-1998'")
def _(t):
    status = M.pl_status(fo_bhav(t), "SYM3", "30-Apr-1998")
    return status.withColumn("b_s_pl_status", F.round("b_s_pl_status", 2)).orderBy("tsp")


@query(
    "mkt_08_pl_status_sql",
    f"WITH {PL} SELECT {_PL} FROM pl WHERE SYMBOL = 'SYM3' AND EXPIRY_DT = '30-Apr-1998'",
)
def _(t):
    return t.spark.sql(
        """
        SELECT * FROM (
          SELECT TIMESTAMP, to_date(TIMESTAMP, 'd-MMM-yyyy') AS tsp, INSTRUMENT, SYMBOL, EXPIRY_DT, CHG_IN_OI, CLOSE,
            OPEN_INT, sum(CHG_IN_OI) OVER w AS cum_chg_oi, round(sum(CHG_IN_OI * CLOSE) OVER w, 2) AS b_s_pl_status
          FROM {fo} WHERE INSTRUMENT LIKE 'FUT%'
          WINDOW w AS (PARTITION BY SYMBOL, EXPIRY_DT, INSTRUMENT ORDER BY to_date(TIMESTAMP, 'd-MMM-yyyy')))
        WHERE SYMBOL = 'SYM3' AND EXPIRY_DT = '30-Apr-1998' ORDER BY tsp
        """,
        fo=fo_bhav(t),
    )


_FPL = f"{_PL}, round(b_s_pl_status - OPEN_INT * CLOSE, 2) AS fpl_status"


def _final(t, symbol=None):
    rows = M.final_pl(fo_bhav(t), symbol)
    return rows.withColumns({c: F.round(c, 2) for c in ("b_s_pl_status", "fpl_status")})


@query("mkt_09_final_pl", f"WITH {PL} SELECT {_FPL} FROM pl WHERE upper(EXPIRY_DT) = TIMESTAMP")
def _(t):
    return _final(t).orderBy("SYMBOL", "tsp")


@query(
    "mkt_09_final_pl_one_symbol",
    f"WITH {PL} SELECT {_FPL} FROM pl WHERE upper(EXPIRY_DT) = TIMESTAMP AND SYMBOL = 'SYM5'",
)
def _(t):
    return _final(t, "SYM5").orderBy("tsp")


@query("mkt_10_persist_final_pl", f"WITH {PL} SELECT {_FPL} FROM pl WHERE upper(EXPIRY_DT) = TIMESTAMP")
def _(t):
    # Parquet files first, then an external table made from them.
    path, name = scratch_path(t.spark, "pl"), fresh_table(t.spark)
    write_parquet(_final(t), path, mode="overwrite")
    write_table(t.spark.read.parquet(path), name, mode="overwrite", path=scratch_path(t.spark, "pl_table"))
    return t.spark.table(name)


def _mv(n):
    return f"avg(CLOSE) OVER (PARTITION BY SYMBOL ORDER BY tsp, TRADE_ID ROWS {n} PRECEDING) AS mv{n}avg"


def _cm(t):
    return M.drop_phantom(cm_bhav(t)).withColumn("tsp", trade_date(F.col("TIMESTAMP")))


@query(
    "mkt_11_moving_averages",
    f"WITH {CM} SELECT SYMBOL, TRADE_ID, tsp, CLOSE, {', '.join(map(_mv, (5, 20, 50, 200)))} FROM cm",
)
def _(t):
    return M.moving_averages(_cm(t).select("SYMBOL", "TRADE_ID", "tsp", "CLOSE"), ["tsp", "TRADE_ID"])


@query(
    "mkt_12_sequence_prices",
    f"WITH {CM} SELECT SYMBOL, TRADE_ID, tsp, CLOSE, row_number() OVER w AS rno, "
    + ", ".join(f'lag(CLOSE, {n}) OVER w AS "CLOSE_{n}"' for n in (5, 10, 15, 20))
    + " FROM cm WINDOW w AS (PARTITION BY SYMBOL ORDER BY tsp, TRADE_ID)",
)
def _(t):
    return M.sequence_prices(_cm(t).select("SYMBOL", "TRADE_ID", "tsp", "CLOSE"), ["tsp", "TRADE_ID"])


BANDS = f"""
{FO},
b AS (SELECT SYMBOL, INSTRUMENT, OPTION_TYP, STRIKE_PR, min(CLOSE) AS mincls, max(CLOSE) AS maxcls, avg(CLOSE) AS mncls
  FROM fo GROUP BY ALL),
l AS (SELECT *, (ceil(50000 / mncls) * 10)::INTEGER AS lotsize FROM b WHERE INSTRUMENT LIKE 'FUT%')
"""


@query("mkt_14_lot_sizes", f"WITH {BANDS} SELECT SYMBOL, INSTRUMENT, round(mncls, 3) AS mncls, lotsize FROM l")
def _(t):
    return M.lot_sizes(fo_bhav(t)).select("SYMBOL", "INSTRUMENT", F.round("mncls", 3).alias("mncls"), "lotsize")


@query(
    "mkt_14_with_lot_size",
    f"WITH {BANDS} SELECT SYMBOL, b.INSTRUMENT AS INSTRUMENT, b.OPTION_TYP AS OPTION_TYP, b.STRIKE_PR AS STRIKE_PR, "
    "b.maxcls AS maxcls, lotsize FROM b JOIN l USING (SYMBOL)",
)
def _(t):
    return M.with_lot_size(fo_bhav(t)).select("SYMBOL", "INSTRUMENT", "OPTION_TYP", "STRIKE_PR", "maxcls", "lotsize")


@query(
    "mkt_15_reshape_bhav",
    f"WITH {FO} SELECT SYMBOL AS symbol, edate::VARCHAR AS expiry, OPTION_TYP AS optiontype, STRIKE_PR AS strikeprice, "
    "tdate::VARCHAR AS tradedate, INSTRUMENT AS instrument, OPEN AS open, HIGH AS high, LOW AS low, CLOSE AS close, "
    "SETTLE_PR AS settle_pr, CONTRACTS AS contracts, VAL_INLAKH AS val, OPEN_INT AS openint, CHG_IN_OI AS chginoi FROM fo",
)
def _(t):
    return M.reshape_bhav(fo_bhav(t))


@query(
    "mkt_16_upsert",
    "SELECT o_custkey, o_orderpriority, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus, "
    "arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice, max(o_orderdate) AS o_orderdate, "
    "arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1, 2",
)
def _(t):
    # Orders up to 1998 are the table and later ones the changes; the last per key wins.
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    base, changes = t.orders.filter(F.col("o_orderdate") < cut), t.orders.filter(F.col("o_orderdate") >= cut)
    return upsert(base, changes, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


@query(
    "mkt_17_oi_summary",
    f"WITH {FO} SELECT SYMBOL, EXPIRY_DT, INSTRUMENT, OPTION_TYP, count(*) AS n, sum(OPEN_INT)::BIGINT AS sum_oi, "
    "round(sum(VAL_INLAKH), 2) AS sum_value FROM fo GROUP BY ALL",
)
def _(t):
    return M.oi_summary(fo_bhav(t)).withColumn("sum_value", F.round("sum_value", 2))
