"""Scalar functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions import dates as D
from marketflow.functions import numbers as N
from marketflow.functions import row_helpers
from marketflow.functions import strings as S
from marketflow.session import ship_module, stored
from marketflow.streaming.sources import with_ingest_time
from marketflow.suite.registry import query

_SHIP = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_K = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _dmy(t):
    """Line items with ship date as 12-JAN-1998 (``tx``) and 12-Jan-1998 (``ex``)."""
    text = F.date_format("l_shipdate", "dd-MMM-yyyy")
    return t.lineitem.select(*_K, "l_shipdate", F.upper(text).alias("tx"), text.alias("ex"))


def _words_per_document(docs: DataFrame) -> DataFrame:
    """(doc_id, word, n).  Words are counted within each text; only texts of repeated ids are shuffled."""
    repeated = docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("again"))
    repeated = stored(repeated, "repeated-ids")
    same = docs["doc_id"].eqNullSafe(repeated["again"])

    def counted(some: DataFrame) -> DataFrame:
        return some.select("doc_id", F.inline(S.word_counts(F.col("text"))))

    if repeated.isEmpty():
        return counted(docs)
    several = counted(docs.join(repeated, same, "left_semi")).groupBy("doc_id", "word").agg(F.sum("n").alias("n"))
    return counted(docs.join(repeated, same, "left_anti")).unionByName(several)


@query(
    "str_02_words",
    "SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) "
    "GROUP BY ALL",
)
def _(t):
    return _words_per_document(t.documents)


@query("str_03_month_name_to_number", f"SELECT {_SHIP}, strftime(l_shipdate, '%d-%m-%Y') AS day FROM lineitem")
def _(t):
    return _dmy(t).select(*_K, D.month_name_to_number(F.col("tx")).alias("day"))


@query(
    "str_04_substring",
    f"SELECT {_SHIP}, strftime(l_shipdate, '%Y') AS yr, strftime(l_shipdate, '%d') AS day, "
    "upper(strftime(l_shipdate, '%b')) AS mon FROM lineitem",
)
def _(t):
    return _dmy(t).select(
        *_K,
        F.substring("tx", -4, 4).alias("yr"),
        F.substring("tx", 0, 2).alias("day"),
        F.substring("tx", 4, 3).alias("mon"),
    )


@query(
    "str_05_month_number",
    f"SELECT {_SHIP}, strftime(l_shipdate, '%m') AS padded, month(l_shipdate)::VARCHAR AS plain FROM lineitem",
)
def _(t):
    name = F.substring("tx", 4, 3)
    return _dmy(t).select(
        *_K, D.month_number(name).alias("padded"), D.month_number(name, pad=False).alias("plain")
    )


@query(
    "str_06_join_fields",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey || ',' || o_custkey || ',' || "
    "o_orderpriority END AS line FROM orders",
)
def _(t):
    # A null field makes the whole line null.
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", S.join_fields("o_orderkey", "o_custkey", priority).alias("line"))


@query(
    "str_07_regex_groups",
    "SELECT c_custkey, 'Customer' AS kind, c_name[10:] AS digits FROM customer",
)
def _(t):
    kind, digits = S.regex_groups(F.col("c_name"), r"^(\w+)#(\d+)$", 2)
    return t.customer.select("c_custkey", kind.alias("kind"), digits.alias("digits"))


@query(
    "str_08_contract_row_key",
    f"SELECT {_SHIP}, 'sS' || l_suppkey || 'e' || epoch(last_day(l_shipdate))::BIGINT || 'oCEp' || l_partkey || 't' || "
    "epoch(l_shipdate)::BIGINT AS k FROM lineitem",
)
def _(t):
    key = S.contract_row_key(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")), F.last_day("l_shipdate"), F.lit("CE"),
        "l_partkey", F.to_date("l_shipdate"),
    )
    return t.lineitem.select(*_K, key.alias("k"))


@query(
    "str_09_day_symbol_key",
    f"SELECT {_SHIP}, strftime(l_shipdate, '%Y-%m-%d') || l_suppkey || 's' || l_returnflag AS k, "
    "year(l_shipdate) || '-' || month(l_shipdate) || strftime(l_shipdate, '-%d') || l_suppkey || 's' || l_returnflag AS plain "
    "FROM lineitem",
)
def _(t):
    day = F.upper(F.date_format("l_shipdate", "dd-MMM-yyyy"))
    symbol = F.col("l_suppkey").cast("string")
    return t.lineitem.select(
        *_K,
        S.day_symbol_key(day, symbol, F.col("l_returnflag")).alias("k"),
        S.day_symbol_key(day, symbol, F.col("l_returnflag"), pad=False).alias("plain"),
    )


@query("str_10_starts_with", "SELECT p_partkey, starts_with(p_name, 'red') AS red, p_type LIKE 'PRO%' AS promo FROM part")
def _(t):
    return t.part.select(
        "p_partkey", F.col("p_name").startswith("red").alias("red"), F.col("p_type").like("PRO%").alias("promo")
    )


@query("str_11_iso_date", f"SELECT {_SHIP}, strftime(l_shipdate, '%Y-%m-%d') AS iso FROM lineitem")
def _(t):
    dmy = F.date_format("l_shipdate", "dd-MM-yyyy")
    return t.lineitem.select(*_K, D.iso_date(dmy).alias("iso"))


@query("dt_01_parse_ts", f"SELECT {_SHIP}, l_shipdate AS ts FROM lineitem")
def _(t):
    dmy = D.month_name_to_number(F.col("tx"))
    return _dmy(t).select(*_K, D.parse_ts(dmy).cast("timestamp_ntz").alias("ts"))


@query("dt_02_parse_date_lenient", f"SELECT {_SHIP}, l_shipdate::DATE AS day FROM lineitem")
def _(t):
    return t.lineitem.select(*_K, D.parse_date_lenient(F.date_format("l_shipdate", "yyyy-M-dd")).alias("day"))


@query(
    "dt_03_year_month",
    f"SELECT {_SHIP}, year(l_shipdate)::INTEGER AS yr, month(l_shipdate)::INTEGER AS mnth FROM lineitem",
)
def _(t):
    return t.lineitem.select(*_K, F.year("l_shipdate").alias("yr"), F.month("l_shipdate").alias("mnth"))


@query("dt_04_day_of_year", f"SELECT {_SHIP}, dayofyear(l_shipdate)::INTEGER AS \"DAY\" FROM lineitem")
def _(t):
    return t.lineitem.select(*_K, D.day_of_year(F.col("l_shipdate")).alias("DAY"))


@query(
    "dt_05_day_of_month",
    "SELECT event_id, day(ts)::INTEGER AS day, ts::DATE AS date FROM events",
)
def _(t):
    return t.events.select("event_id", F.dayofmonth("ts").alias("day"), F.to_date("ts").alias("date"))


@query("dt_06_parse_apache_time", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def _(t):
    text = F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" -0400"))
    return t.events.select("event_id", D.parse_apache_time(text).cast("timestamp_ntz").alias("at"))


@query("dt_07_ingest_time", "SELECT event_id, true AS stamped FROM events")
def _(t):
    rows = with_ingest_time(t.events)
    return rows.select("event_id", (F.col("timestamp") > F.lit("2020-01-01").cast("timestamp")).alias("stamped"))


@query("dt_08_epoch_seconds", f"SELECT {_SHIP}, epoch(l_shipdate)::BIGINT AS s FROM lineitem")
def _(t):
    return t.lineitem.select(*_K, D.epoch_seconds(F.to_date("l_shipdate")).alias("s"))


@query(
    "dt_09_contract_expiry",
    f"SELECT {_SHIP}, (e - to_days(((isodow(e) - 4 + 7) % 7)::INTEGER))::DATE AS expiry FROM (SELECT *, "
    "last_day(CASE WHEN day(l_shipdate) < 21 THEN l_shipdate::DATE ELSE (l_shipdate::DATE + INTERVAL 1 MONTH)::DATE END) AS e "
    "FROM lineitem)",
)
def _(t):
    return t.lineitem.select(*_K, D.contract_expiry(F.to_date("l_shipdate")).alias("expiry"))


@query("dt_10_format_dmy", f"SELECT {_SHIP}, upper(strftime(l_shipdate, '%-d-%b-%Y')) AS day FROM lineitem")
def _(t):
    return t.lineitem.select(*_K, D.format_dmy(F.col("l_shipdate")).alias("day"))


@query(
    "ma_01_arithmetic",
    "SELECT o_orderkey, o_custkey + 7 AS plus, o_custkey - o_orderkey AS minus, o_totalprice * 10 AS times FROM orders",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        (F.col("o_custkey") + 7).alias("plus"),
        (F.col("o_custkey") - F.col("o_orderkey")).alias("minus"),
        (F.col("o_totalprice") * 10).alias("times"),
    )


@query(
    "ma_02_safe_divide",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / nullif(l_tax, 0) AS q FROM lineitem",
)
def _(t):
    return t.lineitem.select(*_K, N.safe_divide(F.col("l_quantity"), F.col("l_tax")).alias("q"))


@query("ma_03_modulo", "SELECT o_orderkey, o_custkey % 7 AS m FROM orders")
def _(t):
    return t.orders.select("o_orderkey", (F.col("o_custkey") % 7).alias("m"))


@query("ma_04_power", "SELECT p_partkey, round(power(p_size, 1.0 / 3), 6) AS root FROM part")
def _(t):
    return t.part.select("p_partkey", F.round(F.power("p_size", F.lit(1.0 / 3)), 6).alias("root"))


@query(
    "ma_05_lot_size",
    "SELECT p_brand, (ceil(50000 / avg(p_retailprice)) * 10)::INTEGER AS lot FROM part GROUP BY 1",
)
def _(t):
    return t.part.groupBy("p_brand").agg(N.lot_size(F.avg("p_retailprice")).alias("lot"))


@query(
    "ma_06_seeded_rand_int",
    "SELECT o_orderkey, true AS in_range, true AS same_again FROM orders",
)
def _(t):
    r, again = N.seeded_rand_int(1, 100), N.seeded_rand_int(1, 100)
    drawn = t.orders.select("o_orderkey", r.alias("r"), again.alias("again"))
    return drawn.select("o_orderkey", F.col("r").between(0, 99).alias("in_range"), (F.col("r") == F.col("again")).alias("same_again"))


@query("ma_07_round", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * 1.001, 5) AS p FROM lineitem")
def _(t):
    return t.lineitem.select(*_K, F.round(F.col("l_extendedprice") * 1.001, 5).alias("p"))


@query(
    "co_01_case_when",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'P' THEN 'part' ELSE 'open' END AS s "
    "FROM orders",
)
def _(t):
    status = F.col("o_orderstatus")
    return t.orders.select("o_orderkey", F.when(status == "F", "done").when(status == "P", "part").otherwise("open").alias("s"))


@query("co_02_is_null", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_tax, 0) IS NULL AS missing FROM lineitem")
def _(t):
    return t.lineitem.select(*_K, F.isnull(F.nullif("l_tax", F.lit(0.0))).alias("missing"))


@query("co_03_literal", "SELECT n_nationkey, 'x' AS tag, 1 AS one FROM nation")
def _(t):
    return t.nation.select("n_nationkey", F.lit("x").alias("tag"), F.lit(1).alias("one"))


@query("ud_01_scalar_udf", "SELECT o_orderkey, o_totalprice * 10 AS tenfold FROM orders")
def _(t):
    @F.pandas_udf(T.DoubleType())
    def tenfold(v: pd.Series) -> pd.Series:
        return v * 10

    return t.orders.select("o_orderkey", tenfold("o_totalprice").alias("tenfold"))


@query("ud_02_registered_udf", "SELECT o_orderkey, upper(o_orderpriority) AS p FROM orders")
def _(t):
    @F.pandas_udf(T.StringType())
    def shout(v: pd.Series) -> pd.Series:
        return v.str.upper()

    t.spark.udf.register("mf_shout", shout)
    return t.spark.sql("SELECT o_orderkey, mf_shout(o_orderpriority) AS p FROM {o}", o=t.orders)


@query("ud_04_shipped_module", "SELECT o_orderkey, strftime(o_orderdate, '%m') AS mm FROM orders")
def _(t):
    ship_module(t.spark, row_helpers.__file__)

    @F.pandas_udf(T.StringType())
    def digits(v: pd.Series) -> pd.Series:
        from row_helpers import month_digits

        return month_digits(v)

    text = F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy"))
    return t.orders.select("o_orderkey", digits(text).alias("mm"))
