"""Logs, market reports, functions and aggregates on rows with known answers."""

import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from marketflow.functions import dates as D
from marketflow.functions import numbers as N
from marketflow.functions import strings as S
from marketflow.operators import aggregates as A
from marketflow.operators import nested as X
from marketflow.operators.collections import upsert, zip_by_position
from marketflow.plans import derivatives as M
from marketflow.plans import logs as L
from marketflow.plans.matches import match_totals
from marketflow.plans.stocks import totals, with_month

LINES = [
    'h1 - - [01/Aug/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 1839',
    'h1 - - [01/Aug/1995:00:00:09 -0400] "GET /b HTTP/1.0" 304 -',
    'h2 - - [02/Aug/1995:10:00:00 -0400] "GET /c" 404 0',
    "this line is broken",
]


@pytest.fixture(scope="module")
def parsed(spark):
    return L.parse_access_log(spark.createDataFrame([(x,) for x in LINES], "value string"))


def test_log_counts(parsed):
    assert tuple(L.log_quality(parsed).first()) == (4, 3, 1)
    good, bad = L.split_log(parsed)
    assert rows(bad) == [("this line is broken",)]
    stats = L.content_size_stats(good).first()
    assert (stats.avg_size, stats.avg_size_int, stats.min_size, stats.max_size) == (613.0, 613, 0, 1839)
    assert rows(L.status_counts(good)) == [(200, 1), (304, 1), (404, 1)]
    assert rows(L.avg_requests_per_host(good)) == [(1, 1, 2, 2.0), (2, 1, 1, 1.0)]
    assert L.size_placeholder_count(parsed).first().n == 1
    assert good.filter("endpoint = '/c'").first().protocol == ""


def test_log_zone_is_ignored_and_text_after_the_size_is_allowed(spark):
    line = LINES[0] + ' "ref" "agent"'
    got = L.split_log(L.parse_access_log(spark.createDataFrame([(line,)], "value string")))[0].first()
    assert got.date_time == dt.datetime(1995, 8, 1, 0, 0, 1) and got.content_size == 1839


def test_matched_but_unreadable_lines_are_quarantined(spark):
    bad = [LINES[0].replace("Aug", "Foo"), LINES[0].replace("1839", "12x")]
    got = L.parse_access_log(spark.createDataFrame([(x,) for x in bad], "value string"))
    assert tuple(L.log_quality(got).first()) == (2, 0, 2)
    assert got.first().host is None


def test_log_pattern_runs_once_per_line(parsed):
    assert plan(L.status_counts(L.split_log(parsed)[0])).count("regexp_replace") == 1


FO = "INSTRUMENT string, SYMBOL string, EXPIRY_DT string, STRIKE_PR double, OPTION_TYP string, CLOSE double, CONTRACTS int, VAL_INLAKH double, OPEN_INT int, CHG_IN_OI int, TIMESTAMP string, _c15 string"  # noqa: E501


@pytest.fixture(scope="module")
def fo(spark):
    data = [
        ("FUTSTK", "INFY", "26-Apr-2018", 0.0, "XX", 10.0, 5, 1.0, 100, 7, "24-APR-2018", None),
        ("FUTSTK", "INFY", "26-Apr-2018", 0.0, "XX", 12.0, 5, 1.0, 110, -2, "25-APR-2018", None),
        ("FUTSTK", "INFY", "26-Apr-2018", 0.0, "XX", 11.0, 1, 1.0, 110, 3, "25-APR-2018", None),
        ("FUTSTK", "INFY", "26-Apr-2018", 0.0, "XX", 9.0, 1, 1.0, 8, -1, "26-APR-2018", None),
        ("OPTSTK", "INFY", "26-Apr-2018", 50.0, "PE", 1.0, 6, 2.0, 40, 0, "24-APR-2018", None),
        ("OPTSTK", "INFY", "26-Apr-2018", 50.0, "CE", 1.0, 4, 2.0, 50, 0, "24-APR-2018", None),
        ("OPTSTK", "INFY", "26-Apr-2018", 55.0, "PE", 1.0, 6, 2.0, 10, 0, "25-APR-2018", None),
        ("OPTSTK", "INFY", "26-Apr-2018", 55.0, "CE", 1.0, 0, 2.0, 0, 0, "25-APR-2018", None),
        ("FUTSTK", "TCS", "31-May-2018", 0.0, "XX", 20.0, 5, 1.0, 10, 1, "24-APR-2018", None),
        ("FUTIDX", "NIFTY", "26-Apr-2018", 0.0, "XX", 20.0, 9, 1.0, 10, 1, "24-APR-2018", None),
    ]
    return spark.createDataFrame(data, FO)


def test_pcr(fo):
    grouped = M.group_instruments(fo)
    assert "_c15" not in grouped.columns
    assert grouped.filter("SYMBOL = 'TCS'").first().DAY == 114
    pcr = {(r.SYMBOL, r.DAY): (r.XX, r.PE, r.CE, r.pcr) for r in M.pcr_by_contracts(grouped).collect()}
    assert pcr == {
        ("INFY", 114): (None, 6, 4, 1.5),
        ("INFY", 115): (None, 6, 0, None),
        ("NIFTY", 114): (9, None, None, None),
    }
    combined = M.process_day_files(fo)
    assert combined.columns == M.PROCESSED
    assert combined.filter("SYMBOL = 'TCS'").count() == 0
    assert combined.filter("INSTRUMENT = 'FUTSTK' and DAY = 114").first().PCR == 1.5
    oi = {r.TIMESTAMP: (r.totce, r.totpe, r.pcr) for r in M.pcr_by_open_interest(fo).collect()}
    assert oi == {"24-APR-2018": (50, 40, 0.8), "25-APR-2018": (0, 10, None)}


def test_pl_sums_ties_together(fo):
    got = rows(M.pl_status(fo, "INFY", "26-Apr-2018"), "TIMESTAMP", "CLOSE", "cum_chg_oi", "b_s_pl_status")
    assert got == [
        ("24-APR-2018", 10.0, 7, 70.0),
        ("25-APR-2018", 11.0, 8, 79.0),
        ("25-APR-2018", 12.0, 8, 79.0),
        ("26-APR-2018", 9.0, 7, 70.0),
    ]
    assert rows(M.final_pl(fo), "SYMBOL", "fpl_status") == [("INFY", -2.0)]


def test_market_direction(spark):
    df = spark.createDataFrame([(x,) for x in (1.3, 1.2, 0.9, 0.8, 0.7, 0.6, 0.5, None)], "p double")
    got = [r.d for r in df.select(N.market_direction(F.col("p")).alias("d")).collect()]
    assert got == [
        "extreme bullish", "bullish", "bullish", "neutral", "bearish", "bearish", "extreme bearish", None,
    ]


def test_lot_size_repeats_rows_per_futures_band(spark, fo):
    lots = M.with_lot_size(fo)
    assert lots.filter("SYMBOL = 'INFY'").count() == 5
    assert M.lot_sizes(fo).filter("SYMBOL = 'TCS'").first().lotsize == 25000


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(col(F.col("c")).alias("x")).first().x


def test_dates(spark):
    assert one(spark, D.month_name_to_number, "12-JAN-2019") == "12-01-2019"
    assert one(spark, D.month_name_to_number, "26-Apr-2018") == "26-04-2018"
    with pytest.raises(Exception, match="CANNOT_PARSE|parse"):
        one(spark, D.month_name_to_number, "12-FOO-2019")
    assert one(spark, D.try_trade_date, "12-FOO-2019") is None
    assert one(spark, D.parse_date_lenient, "2017-5-02") == dt.date(2017, 5, 2)
    assert one(spark, D.month_number, "SEP") == "09"
    assert one(spark, lambda c: D.month_number(c, pad=False), "JAN") == "1"
    assert one(spark, D.file_date, "fo01JUN2023bhav.csv.gz") == dt.date(2023, 6, 1)
    expiry = [(dt.date(2021, 2, 3), dt.date(2021, 2, 25)), (dt.date(2020, 12, 21), dt.date(2021, 1, 28)),
              (dt.date(2021, 1, 31), dt.date(2021, 2, 25))]
    for day, want in expiry:
        assert one(spark, D.contract_expiry, day, "date") == want
    assert one(spark, lambda c: D.contract_expiry(c, "FRI"), dt.date(2021, 2, 3), "date") == dt.date(2021, 2, 26)


def test_strings(spark):
    df = spark.createDataFrame([("S", dt.date(2018, 4, 26), "CE", 50.0, dt.date(2018, 1, 1))], "s string, e date, o string, p double, t date")
    key = S.contract_row_key(F.col("s"), F.col("e"), F.col("o"), "p", F.col("t"))
    assert df.select(key.alias("k")).first().k == "sSe1524700800oCEp50.0t1514764800"
    assert one(spark, lambda c: S.day_symbol_key(c, F.lit("INFY"), F.lit("EQ")), "05-JAN-2018") == "2018-01-05INFYsEQ"
    assert one(spark, lambda c: S.day_symbol_key(c, F.lit("INFY"), F.lit("EQ"), pad=False), "05-JAN-2018") == "2018-1-05INFYsEQ"
    assert one(spark, lambda c: S.csv_field(c, 9), "a,b") is None


def test_geometric_mean(spark):
    df = spark.createDataFrame([([1, 2, 4],)], "v array<int>")
    assert round(df.select(N.geometric_mean("v").alias("g")).first().g, 9) == 2.0


def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 5)], "v int")
    assert rows(A.histogram(df, "v", 2)) == [(0, 1.0, 3.0, 2), (1, 3.0, 5.0, 3)]
    same = spark.createDataFrame([(7,), (7,)], "v int")
    assert rows(A.histogram(same, "v", 10), "bucket", "n") == [(0, 2)]


def test_population_statistics(spark):
    got = A.numeric_stats(spark.createDataFrame([(float(x),) for x in range(1, 5)], "v double"), "v").first()
    assert (got.mean, got.variance) == (2.5, 1.25)


def test_tree_aggregate_equals_flat(spark):
    df = spark.range(1, 13, numPartitions=6)
    assert tuple(A.tree_sum_and_count(df, "id", 3).first()) == tuple(A.sum_and_count(df, "id").first()) == (78, 12)
    none = df.filter("id > 99")
    assert tuple(A.tree_sum_and_count(none, "id").first()) == (None, 0)


def test_group_members_split(spark):
    df = spark.range(25).select((F.col("id") % 2).alias("k"), "id")
    got = A.group_members(df, ["k"], "id", ["id"], page_rows=5)
    parts = {(r.k, r.page): r.members for r in got.collect()}
    assert max(map(len, parts.values())) == 5
    joined = [x for key in sorted(parts) if key[0] == 0 for x in parts[key]]
    assert joined == list(range(0, 25, 2))


def test_zip_and_upsert(spark):
    a, b = spark.createDataFrame([(1,), (2,), (3,)], "x int"), spark.createDataFrame([(3,), (4,), (5,)], "y int")
    assert rows(zip_by_position(a, b, ["x"], ["y"])) == [(1, 3), (2, 4), (3, 5)]
    base = spark.createDataFrame([("k", 1, "a"), ("l", 1, "b")], "k string, n int, v string")
    new = spark.createDataFrame([("k", 2, "c"), ("m", 1, "d")], "k string, n int, v string")
    assert rows(upsert(base, new, ["k"], ["n"])) == [("k", 2, "c"), ("l", 1, "b"), ("m", 1, "d")]


def test_matches(spark):
    ddl = "id long, year long, matches long"
    test = spark.createDataFrame([(1, 2000, 6), (1, 2002, 16)], ddl)
    odi = spark.createDataFrame([(1, 2000, 34), (2, 2002, 5)], ddl)
    assert rows(match_totals(test, odi)) == [(1, 2000, 6, 34, 40), (1, 2002, 16, 0, 16)]


def test_cube_and_grouping_sets(spark):
    ddl = "symbol string, trdate string, qty int, vlu double"
    data = [("INFY", "2017-05-01", 2000, 10.0), ("INFY", "2017-5-02", 1954, 20.0), ("SBIN", "2017-06-03", 5, 1.0)]
    monthly = with_month(spark.createDataFrame(data, ddl))
    total = totals(monthly, "cube").filter("symbol is null and yr is null and mnth is null").first()
    assert (total.qty, total.vlu) == (3959, 31.0)
    sets = totals(monthly, "sets", sets=[("symbol", "yr"), ("symbol", "mnth"), ("symbol",)], set_id="set_id")
    assert rows(sets.filter("symbol = 'INFY'"), "yr", "mnth", "qty") == [(2017, None, 3954), (None, 5, 3954), (None, None, 3954)]


def test_json_keeps_nulls_out_and_parses_back(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    assert rows(X.to_json_column(df, ["a", "b"])) == [('{"a":1}',), ('{"a":2,"b":"b"}',)]
    packed = X.encode_struct(df.select(F.struct("a", "b").alias("s")), "s")
    assert packed.schema["payload"].dataType.simpleString() == "binary"
    assert rows(X.decode_struct(packed, "payload", "a int, b string").select("record.*")) == [(1, None), (2, "b")]


def test_json_inference(spark):
    texts = ['{"a":1,"b c":{"x":1.5},"t":[1,2],"n":null,"m":"s"}', '{"a":2.5,"t":["x"],"m":3,"k":true}', "bad{"]
    df = spark.createDataFrame([(x,) for x in texts], "v string")
    got = X.infer_json_schema(df, "v").simpleString()
    assert got == "struct<a:double,b c:struct<x:double>,k:boolean,m:string,n:string,t:array<string>>"
    assert [r.a for r in X.json_strings_to_df(df, "v").filter("a is not null").orderBy("a").collect()] == [1.0, 2.5]
