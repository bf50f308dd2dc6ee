"""Domain tables as Spark views of the test tables, and the same in SQL.

``FO``/``CM``/``LOG``/``CELLS`` are WITH clauses that queries prepend to their SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.suite.registry import Tables


def fo_bhav(t: Tables) -> DataFrame:
    """Derivatives rows from line items: a line number is a symbol, a month end an expiry."""
    stock = F.col("l_linestatus") == "O"
    option = F.col("l_returnflag") != "N"
    return t.lineitem.select(
        F.when(~option, F.when(stock, "FUTSTK").otherwise("FUTIDX"))
        .otherwise(F.when(stock, "OPTSTK").otherwise("OPTIDX"))
        .alias("INSTRUMENT"),
        F.concat(F.lit("SYM"), F.col("l_linenumber").cast("string")).alias("SYMBOL"),
        F.date_format(F.last_day("l_shipdate"), "dd-MMM-yyyy").alias("EXPIRY_DT"),
        F.when(option, (F.col("l_partkey") % 20 * 50).cast("double")).otherwise(0.0).alias("STRIKE_PR"),
        F.when(~option, "XX").when(F.col("l_returnflag") == "A", "CE").otherwise("PE").alias("OPTION_TYP"),
        (F.col("l_extendedprice") - F.col("l_quantity")).alias("OPEN"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("HIGH"),
        (F.col("l_extendedprice") - 2 * F.col("l_quantity")).alias("LOW"),
        F.col("l_extendedprice").alias("CLOSE"),
        F.col("l_extendedprice").alias("SETTLE_PR"),
        F.col("l_quantity").cast("int").alias("CONTRACTS"),
        F.col("l_extendedprice").alias("VAL_INLAKH"),
        F.col("l_partkey").cast("int").alias("OPEN_INT"),
        (F.round(F.col("l_discount") * 100).cast("int") - 5).alias("CHG_IN_OI"),
        F.upper(F.date_format("l_shipdate", "dd-MMM-yyyy")).alias("TIMESTAMP"),
        F.lit(None).cast("string").alias("_c15"),
        F.col("l_orderkey").alias("TRADE_ID"),
    )


FO = """
fo AS (SELECT
    CASE WHEN l_returnflag = 'N' THEN CASE WHEN l_linestatus = 'O' THEN 'FUTSTK' ELSE 'FUTIDX' END
         ELSE CASE WHEN l_linestatus = 'O' THEN 'OPTSTK' ELSE 'OPTIDX' END END AS INSTRUMENT,
    'SYM' || l_linenumber AS SYMBOL,
    strftime(last_day(l_shipdate), '%d-%b-%Y') AS EXPIRY_DT,
    CASE WHEN l_returnflag <> 'N' THEN (l_partkey % 20 * 50)::DOUBLE ELSE 0.0::DOUBLE END AS STRIKE_PR,
    CASE l_returnflag WHEN 'N' THEN 'XX' WHEN 'A' THEN 'CE' ELSE 'PE' END AS OPTION_TYP,
    l_extendedprice - l_quantity AS OPEN, l_extendedprice + l_quantity AS HIGH,
    l_extendedprice - 2 * l_quantity AS LOW, l_extendedprice AS CLOSE, l_extendedprice AS SETTLE_PR,
    l_quantity::INTEGER AS CONTRACTS, l_extendedprice AS VAL_INLAKH, l_partkey::INTEGER AS OPEN_INT,
    round(l_discount * 100)::INTEGER - 5 AS CHG_IN_OI,
    upper(strftime(l_shipdate, '%d-%b-%Y')) AS TIMESTAMP,
    l_shipdate::DATE AS tdate, last_day(l_shipdate)::DATE AS edate, l_orderkey AS TRADE_ID
  FROM lineitem)
"""


def cm_bhav(t: Tables) -> DataFrame:
    """Cash-market rows from orders: a priority is a symbol, so symbols are few and large.

    Prices are in hundredths, so that sums and averages are exact in both engines.
    """
    return t.orders.select(
        F.upper(F.substring("o_orderpriority", 3, 20)).alias("SYMBOL"),
        F.col("o_orderstatus").alias("SERIES"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("CLOSE"),
        F.col("o_custkey").alias("TOTTRDQTY"),
        F.col("o_totalprice").alias("TOTTRDVAL"),
        F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")).alias("TIMESTAMP"),
        F.col("o_orderkey").alias("TRADE_ID"),
        F.lit(None).cast("string").alias("_c13"),
    )


CM = """
cm AS (SELECT upper(substring(o_orderpriority, 3, 20)) AS SYMBOL, o_orderstatus AS SERIES,
    round(o_totalprice * 100)::BIGINT AS CLOSE, o_custkey AS TOTTRDQTY, o_totalprice AS TOTTRDVAL,
    upper(strftime(o_orderdate, '%d-%b-%Y')) AS TIMESTAMP, o_orderkey AS TRADE_ID,
    o_orderdate::DATE AS tsp
  FROM orders)
"""

# Fixed rule of the rendered log, per event type: method, status code.
LOG_RULE = {
    "view": ("GET", 200),
    "click": ("GET", 304),
    "signup": ("POST", 302),
    "purchase": ("POST", 200),
    "error": ("GET", 500),
}


def log_lines(t: Tables) -> DataFrame:
    """Access-log lines from events.

    Cheap events make damaged lines: below 1 the line is cut off, below 2 the month is unknown,
    below 3 the size is not a number.  Clicks have no size (``-``).
    """
    kind = F.col("event_type")
    method = F.when(kind.isin("signup", "purchase"), "POST").otherwise("GET")
    code = F.lit("200")
    for name, (_, status) in LOG_RULE.items():
        code = F.when(kind == name, str(status)).otherwise(code)
    value = F.col("value")
    time = F.when((value >= 1) & (value < 2), F.lit("01/Foo/2024:00:00:00")).otherwise(
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    )
    size = (
        F.when((value >= 2) & (value < 3), "big")
        .when(kind == "click", "-")
        .otherwise(F.round(value * 100).cast("int").cast("string"))
    )
    line = F.concat(
        F.lit("h"), F.col("user_id").cast("string"), F.lit(" - - ["), time, F.lit(' -0400] "'),
        method, F.lit(" /"), kind, F.lit(' HTTP/1.0" '), code, F.lit(" "), size,
    )
    broken = F.concat(F.lit("broken line "), F.col("event_id").cast("string"))
    return t.events.select(F.when(value < 1, broken).otherwise(line).alias("value"))


LOG = """
log AS (SELECT event_id, 'h' || user_id AS host, date_trunc('second', ts) AS date_time,
    CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS method,
    '/' || event_type AS endpoint,
    CASE event_type WHEN 'click' THEN 304 WHEN 'signup' THEN 302 WHEN 'error' THEN 500 ELSE 200 END
      ::INTEGER AS response_code,
    CASE WHEN event_type = 'click' THEN 0 ELSE round(value * 100)::INTEGER END::INTEGER AS content_size,
    event_type = 'click' AS size_missing, value >= 3 AS ok, value,
    CASE WHEN value < 1 THEN 'broken line ' || event_id
      ELSE 'h' || user_id || ' - - [' ||
        CASE WHEN value < 2 THEN '01/Foo/2024:00:00:00' ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END ||
        ' -0400] "' || CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END || ' /' || event_type ||
        ' HTTP/1.0" ' || CASE event_type WHEN 'click' THEN '304' WHEN 'signup' THEN '302' WHEN 'error' THEN '500' ELSE '200' END ||
        ' ' || CASE WHEN value >= 2 AND value < 3 THEN 'big' WHEN event_type = 'click' THEN '-'
          ELSE round(value * 100)::INTEGER::VARCHAR END END AS line
  FROM events)
"""


def cells_of(t: Tables) -> DataFrame:
    """Cells from events: user = row, event type = family, ``k`` of props = qualifier.

    Purchases below 10 are deletes: below 2 of the row, below 5 of the view
    family, else of a column in it.
    """
    k = F.concat(F.lit("k"), F.get_json_object("props", "$.k"))
    dead = (F.col("event_type") == "purchase") & (F.col("value") < 10)
    return t.events.select(
        F.lpad(F.col("user_id").cast("string"), 10, "0").alias("row"),
        F.when(dead & (F.col("value") < 2), F.lit(None))
        .when(dead, F.lit("view"))
        .otherwise(F.col("event_type"))
        .alias("family"),
        F.when(dead & (F.col("value") < 5), F.lit(None)).otherwise(k).alias("qualifier"),
        F.col("event_id").alias("ts"),
        F.lit(0).cast("long").alias("seq"),
        F.when(~dead, F.round("value", 2).cast("string")).alias("value"),
        dead.alias("is_delete"),
    )


CELLS = """
raw AS (SELECT *, event_type = 'purchase' AND value < 10 AS dead, 'k' || (props::JSON ->> '$.k') AS k
  FROM events),
cells AS (SELECT lpad(user_id::VARCHAR, 10, '0') AS "row",
    CASE WHEN dead AND value < 2 THEN NULL WHEN dead THEN 'view' ELSE event_type END AS family,
    CASE WHEN dead AND value < 5 THEN NULL ELSE k END AS qualifier,
    event_id AS ts, CASE WHEN NOT dead THEN round(value, 2)::VARCHAR END AS value, dead AS is_delete
  FROM raw),
visible AS (SELECT c."row", c.family, c.qualifier, c.ts, c.value FROM cells c
  WHERE NOT c.is_delete AND NOT EXISTS (SELECT 1 FROM cells d WHERE d.is_delete AND d."row" = c."row"
    AND d.ts >= c.ts AND (d.family IS NULL OR d.family = c.family)
    AND (d.qualifier IS NULL OR d.qualifier = c.qualifier))),
latest AS (SELECT "row", family, qualifier, max(ts) AS ts, arg_max(value, ts) AS value
  FROM visible GROUP BY ALL)
"""
