"""Cell-table operators over cells made from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.operators import cell_filters as CF
from marketflow.operators import cells as C
from marketflow.operators.aggregates import concat_frames
from marketflow.suite.derived import CELLS, FO, cells_of, fo_bhav
from marketflow.suite.registry import query

_C = '"row", family, qualifier, ts, value'
LATEST = f"WITH {CELLS} SELECT {_C} FROM latest"


@query("cl_01_latest", LATEST)
def _(t):
    return C.latest(cells_of(t))


_RANKED = f"(SELECT *, row_number() OVER (PARTITION BY \"row\", family, qualifier ORDER BY ts DESC) AS rn FROM visible)"


@query("cl_02_versions", f"WITH {CELLS} SELECT {_C} FROM {_RANKED} WHERE rn <= 3")
def _(t):
    return C.versions(cells_of(t), 3)


# Earlier state: only mutations up to event 6000 exist.
PAST = CELLS.replace("FROM raw)", "FROM raw WHERE event_id <= 6000)")


@query("cl_03_versions_as_of", f"WITH {PAST} SELECT {_C} FROM {_RANKED} WHERE rn <= 2")
def _(t):
    return C.versions(cells_of(t), 2, as_of_ts=6000)


def _keys(t):
    """Row keys of users who bought something above 100."""
    big = t.events.filter("event_type = 'purchase' AND value > 100")
    return big.select(F.lpad(F.col("user_id").cast("string"), 10, "0").alias("row"))


_KEYS = "SELECT lpad(user_id::VARCHAR, 10, '0') FROM events WHERE event_type = 'purchase' AND value > 100"


@query("cl_04_rows_as_of", f"WITH {PAST} SELECT {_C} FROM latest WHERE \"row\" IN ({_KEYS})")
def _(t):
    return C.get_rows(cells_of(t), _keys(t), as_of_ts=6000)


@query("cl_05_get_rows", f"{LATEST} WHERE \"row\" IN ({_KEYS})")
def _(t):
    return C.get_rows(cells_of(t), _keys(t))


@query(
    "cl_06_select_columns",
    f"{LATEST} WHERE family = 'view' OR (family = 'click' AND qualifier = 'k7')",
)
def _(t):
    return C.select_columns(C.latest(cells_of(t)), ["view", "click:k7"])


@query("cl_06_qualifier_regex", f"{LATEST} WHERE regexp_matches(qualifier, '^k[1-3].$')")
def _(t):
    return C.select_columns(C.latest(cells_of(t)), qualifier_regex="^k[1-3].$")


@query("cl_07_get_cell", f"{LATEST} WHERE \"row\" = '0000000007' AND family = 'view' AND qualifier IN ('k16', 'k39', 'k45', 'k53')")
def _(t):
    found = [C.get_cell(cells_of(t), "0000000007", f"view:k{i}") for i in (16, 39, 45, 53)]
    return concat_frames(found)


@query(
    "cl_08_row_maps",
    f"WITH {CELLS} SELECT \"row\", 0::BIGINT AS page, count(*)::INTEGER AS n, "
    "string_agg(family || ':' || qualifier || '=' || value || '@' || ts, ',' ORDER BY family || ':' || qualifier) AS cells "
    "FROM latest GROUP BY 1",
)
def _(t):
    maps = C.as_row_maps(cells_of(t))
    entries = F.transform(
        F.array_sort(F.map_entries("cells")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"]["value"], F.lit("@"), e["value"]["ts"].cast("string")),
    )
    return maps.select("row", "page", F.size("cells").alias("n"), F.array_join(entries, ",").alias("cells"))


@query("cl_09_full_scan", f"{LATEST} ORDER BY 1, 2, 3")
def _(t):
    return C.scan(cells_of(t))


@query("cl_10_range_scan", f"{LATEST} WHERE \"row\" >= '0000000020' AND \"row\" < '0000000090'")
def _(t):
    return C.scan(cells_of(t), start="0000000020", stop="0000000090")


@query("cl_10_scan_from", f"{LATEST} WHERE \"row\" >= '0000000100'")
def _(t):
    return C.scan(cells_of(t), start="0000000100")


@query("cl_11_prefix_scan", f"{LATEST} WHERE \"row\" LIKE '00000000%'")
def _(t):
    return C.scan(cells_of(t), prefix="00000000")


@query("cl_12_scan_exact_ts", f"WITH {CELLS} SELECT {_C} FROM visible WHERE ts = 4242")
def _(t):
    return C.scan(cells_of(t), ts=4242)


@query(
    "cl_13_scan_spec",
    f"{LATEST} WHERE \"row\" >= '0000000010' AND \"row\" < '0000000140' AND family IN ('view', 'error') AND value <> '' "
    "AND qualifier LIKE 'k4%' ORDER BY \"row\" DESC",
)
def _(t):
    spec = C.ScanSpec(
        start="0000000010", stop="0000000140", columns=["view", "error"], reverse=True,
        filter_string="ColumnPrefixFilter('k4') AND ValueFilter(!=, 'binary:')",
    )
    return C.scan(cells_of(t), spec)


def _batch(t):
    """One new value per supplier, under the row keys users have."""
    return t.supplier.select(
        F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("row"),
        F.lit("view").alias("family"),
        F.lit("k1").alias("qualifier"),
        F.lit(None).cast("bigint").alias("ts"),
        F.col("s_name").alias("value"),
    )


def _ordered_batch(t):
    """Three values for one cell of every supplier, out of order; the last by ``pos`` is the one above."""
    batch = _batch(t)
    parts = [batch.withColumns({"value": F.concat(F.lit(f"{n}-"), "value"), "pos": F.lit(n)}) for n in (1, 2)]
    last = batch.withColumn("pos", F.lit(3))
    return last.unionByName(parts[1]).unionByName(parts[0]).repartition(5, "value")


def _with_batch(ts):
    extra = (
        f" UNION ALL SELECT lpad(s_suppkey::VARCHAR, 10, '0'), 'view', 'k1', {ts}::BIGINT, s_name, false FROM supplier"
    )
    return CELLS.replace("FROM raw)", f"FROM raw{extra})")


@query("cl_14_put", f"WITH {_with_batch(20000000000)} SELECT {_C} FROM latest")
def _(t):
    return C.latest(C.put(cells_of(t), _ordered_batch(t).withColumn("ts", F.lit(20000000000).cast("bigint")), order="pos"))


@query("cl_15_mutate", f"WITH {_with_batch(30000000000)} SELECT {_C} FROM latest")
def _(t):
    return C.latest(C.mutate(cells_of(t), _ordered_batch(t).drop("ts"), 30000000000, order="pos"))


@query("cl_16_put_old_timestamp", f"WITH {_with_batch(5)} SELECT {_C} FROM latest")
def _(t):
    return C.latest(C.put(cells_of(t), _batch(t).withColumn("ts", F.lit(5).cast("bigint"))))


@query(
    "cl_17_delete",
    f"{LATEST} WHERE NOT (ts <= 9000 AND (\"row\" < '0000000010' OR (\"row\" < '0000000020' AND family = 'view') "
    "OR (\"row\" < '0000000030' AND family = 'click' AND qualifier = 'k3')))",
)
def _(t):
    cells = cells_of(t)
    rows = cells.select("row").distinct()
    gone = C.delete(cells, rows.filter("row < '0000000010'"), 9000)
    gone = C.delete(gone, rows.filter("row < '0000000020'").withColumn("family", F.lit("view")), 9000)
    column = rows.filter("row < '0000000030'").withColumns({"family": F.lit("click"), "qualifier": F.lit("k3")})
    return C.latest(C.delete(gone, column, 9000))


@query(
    "cl_18_prune_versions",
    f"WITH {CELLS} SELECT {_C} FROM (SELECT *, row_number() OVER (PARTITION BY \"row\", family, qualifier ORDER BY ts DESC) AS rn "
    "FROM visible WHERE family <> 'error' OR ts >= 8000 - 3000) WHERE rn <= CASE family WHEN 'view' THEN 1 WHEN 'click' "
    "THEN 2 ELSE 3 END",
)
def _(t):
    return C.prune_versions(cells_of(t), {"view": 1, "click": 2}, ttl={"error": 3000}, now=8000)


@query(
    "cl_19_increment",
    "SELECT lpad(user_id::VARCHAR, 10, '0') AS \"row\", 'n' AS family, event_type AS qualifier, 2::BIGINT AS ts, "
    "(sum(round(value)::BIGINT) + count(*) FILTER (value > 10))::VARCHAR AS value FROM events WHERE event_type <> 'error' "
    "GROUP BY ALL",
)
def _(t):
    # Counters start from whole values; a second round adds one per event above 10.  Before it, the
    # columns of errors are overwritten by texts, which are no counters and stay as they are.
    keyed = t.events.select(
        F.lpad(F.col("user_id").cast("string"), 10, "0").alias("row"),
        F.lit("n").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.round("value").cast("bigint").alias("delta"),
        (F.col("value") > 10).cast("bigint").alias("more"),
    )
    empty = t.spark.createDataFrame([], C.SCHEMA)
    first = C.increment(empty, keyed.drop("more"), 1)
    texts = first.filter("qualifier = 'error'").withColumns({"value": F.lit("12.5"), "ts": F.lit(2).cast("bigint")})
    stored = C.put(C.put(empty, first), texts)
    return C.increment(stored, keyed.drop("delta").withColumnRenamed("more", "delta"), 2, skip_bad=True)


@query(
    "cl_20_append_values",
    f"WITH {CELLS} SELECT lpad(s_suppkey::VARCHAR, 10, '0') AS \"row\", 'view' AS family, 'k1' AS qualifier, 7::BIGINT AS ts, "
    "coalesce((SELECT value FROM latest l WHERE l.\"row\" = lpad(s_suppkey::VARCHAR, 10, '0') AND l.family = 'view' AND "
    "l.qualifier = 'k1'), '') || '+' || s_name || '+' || s_suppkey AS value FROM supplier",
)
def _(t):
    # Two texts for each column, the second one listed first.
    name = _batch(t).select("row", "family", "qualifier", F.concat(F.lit("+"), "value").alias("text"), F.lit(1).alias("pos"))
    number = F.concat(F.lit("+"), F.col("row").cast("bigint").cast("string"))
    texts = name.withColumns({"text": number, "pos": F.lit(2)}).unionByName(name)
    return C.append_values(cells_of(t), texts, 7, order="pos")


@query(
    "cl_21_check_and_put",
    f"WITH {CELLS}, a AS (SELECT lpad(c_custkey::VARCHAR, 10, '0') AS \"row\", 'view' AS family, 'k1' AS qualifier, "
    "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE '12.5' END AS expected, n FROM customer, (VALUES (1::INTEGER), (2)) v(n)) "
    "SELECT a.\"row\" AS \"row\", n, a.expected AS expected, l.value AS current, "
    "n = 1 AND a.expected IS NOT DISTINCT FROM l.value AS passed FROM a LEFT JOIN latest l USING (\"row\", family, qualifier)",
)
def _(t):
    attempts = t.customer.select(
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("row"),
        F.lit("view").alias("family"),
        F.lit("k1").alias("qualifier"),
        F.when(F.col("c_custkey") % 2 != 0, "12.5").alias("expected"),
        F.lit("new").alias("value"),
    )
    # Everybody tries twice; only the first may pass.
    twice = attempts.withColumn("n", F.lit(2)).unionByName(attempts.withColumn("n", F.lit(1)))
    return C.check_and_put(cells_of(t), twice, order="n").select("row", "n", "expected", "current", "passed")


@query("cl_22_count_rows", f"WITH {CELLS} SELECT count(DISTINCT \"row\") AS n FROM latest")
def _(t):
    return C.count_rows(cells_of(t))


@query("cl_23_list_families", f"WITH {CELLS} SELECT DISTINCT family FROM latest")
def _(t):
    return C.list_families(cells_of(t))


_KEY = (
    "'s' || SYMBOL || 'e' || epoch(edate)::BIGINT || 'o' || OPTION_TYP || 'p' || printf('%.1f', STRIKE_PR) || 't' || "
    "epoch(tdate)::BIGINT"
)


_CELL = (
    "CASE q WHEN 'OPR' THEN OPEN WHEN 'HPR' THEN HIGH WHEN 'LPR' THEN LOW WHEN 'CPR' THEN CLOSE WHEN 'SPR' THEN SETTLE_PR "
    "WHEN 'CNTRS' THEN CONTRACTS WHEN 'VLKH' THEN VAL_INLAKH WHEN 'OI' THEN OPEN_INT ELSE CHG_IN_OI END"
)
_QUALIFIERS = "(SELECT unnest(['OPR','HPR','LPR','CPR','SPR','CNTRS','VLKH','OI','CHGOI']) AS q)"


@query(
    "cl_24_bhav_to_cells",
    f"WITH {FO} SELECT {_KEY} AS \"row\", 'D' AS family, q AS qualifier, TRADE_ID AS ts, {_CELL}::DOUBLE AS value "
    f"FROM fo CROSS JOIN {_QUALIFIERS}",
)
def _(t):
    # The texts are compared as numbers, since the two engines write large ones differently.
    cells = C.bhav_to_cells(fo_bhav(t), F.col("TRADE_ID"))
    return cells.select("row", "family", "qualifier", "ts", F.col("value").cast("double").alias("value"))


@query(
    "cl_24_bhav_cell_totals",
    f"WITH {FO} SELECT q AS qualifier, count(*) AS n, round(sum({_CELL}), 2) AS total FROM fo CROSS JOIN {_QUALIFIERS} GROUP BY 1",
)
def _(t):
    cells = C.bhav_to_cells(fo_bhav(t), F.col("TRADE_ID"))
    return cells.groupBy("qualifier").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("value").cast("double")), 2).alias("total")
    )


_MAP = {"status": "o:st", "priority": "o:pr", "cust": "c:id"}


def _order_cells(t):
    wide = t.orders.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
        F.col("o_custkey").alias("cust"),
    )
    key = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    return C.wide_to_cells(wide, key, _MAP, 1)


_ROW = "lpad(o_orderkey::VARCHAR, 12, '0') AS \"row\""


@query(
    "cl_25_cells_to_wide",
    f"SELECT {_ROW}, o_orderstatus AS status, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority, "
    "o_custkey::VARCHAR AS cust FROM orders",
)
def _(t):
    return C.cells_to_wide(_order_cells(t), _MAP)


@query(
    "cl_26_wide_to_cells",
    f"SELECT {_ROW}, 'o' AS family, 'st' AS qualifier, o_orderstatus AS value FROM orders UNION ALL "
    f"SELECT {_ROW}, 'o', 'pr', o_orderpriority FROM orders WHERE o_orderstatus <> 'P' UNION ALL "
    f"SELECT {_ROW}, 'c', 'id', o_custkey::VARCHAR FROM orders",
)
def _(t):
    return _order_cells(t).select("row", "family", "qualifier", "value")


# --- filters -----------------------------------------------------------------------------------

_POS = "(SELECT *, row_number() OVER (PARTITION BY \"row\" ORDER BY family, qualifier) AS pos FROM latest)"
_FROM_POS = f"WITH {CELLS} SELECT {_C} FROM {_POS}"

FILTERS = {
    "cf_01_key_only": (
        lambda: CF.key_only(), f"WITH {CELLS} SELECT \"row\", family, qualifier, ts, '' AS value FROM latest",
    ),
    "cf_02_first_key_only": (lambda: CF.first_key_only(), f"{_FROM_POS} WHERE pos = 1"),
    "cf_03_column_prefix": (lambda: CF.column_prefix("k1"), f"{LATEST} WHERE qualifier LIKE 'k1%'"),
    "cf_03_multiple_column_prefix": (
        lambda: CF.column_prefix("k1", "k25"), f"{LATEST} WHERE qualifier LIKE 'k1%' OR qualifier LIKE 'k25%'",
    ),
    "cf_04_column_count": (lambda: CF.column_count(5), f"{_FROM_POS} WHERE pos <= 5"),
    "cf_05_page": (
        lambda: CF.page(10),
        f"{LATEST} WHERE \"row\" IN (SELECT DISTINCT \"row\" FROM latest ORDER BY 1 LIMIT 10)",
    ),
    "cf_06_column_page": (lambda: CF.column_page(3, 2), f"{_FROM_POS} WHERE pos > 2 AND pos <= 5"),
    "cf_07_inclusive_stop": (lambda: CF.inclusive_stop("0000000020"), f"{LATEST} WHERE \"row\" <= '0000000020'"),
    "cf_08_row_binary": (lambda: CF.row_filter("=", "binary:0000000007"), f"{LATEST} WHERE \"row\" = '0000000007'"),
    "cf_08_row_substring": (lambda: CF.row_filter("=", "substring:07"), f"{LATEST} WHERE \"row\" LIKE '%07%'"),
    "cf_08_row_regex": (lambda: CF.row_filter("!=", "regexstring:[12]$"), f"{LATEST} WHERE NOT regexp_matches(\"row\", '[12]$')"),
    "cf_09_timestamps": (
        lambda: CF.timestamps([9001, 9002, 9003, 9004, 9005]), f"{LATEST} WHERE ts BETWEEN 9001 AND 9005",
    ),
    "cf_10_family": (lambda: CF.family_filter("=", "substring:IE"), f"{LATEST} WHERE family LIKE '%ie%'"),
    "cf_11_qualifier": (lambda: CF.qualifier_filter(">", "binary:k50"), f"{LATEST} WHERE qualifier > 'k50'"),
    "cf_12_value_regex": (
        lambda: CF.value_filter("=", r"regexstring:^1\d\."), f"{LATEST} WHERE regexp_matches(value, '^1\\d\\.')",
    ),
    "cf_13_dependent_column": (
        lambda: CF.dependent_column("view", "k10"),
        f"{LATEST} WHERE EXISTS (SELECT 1 FROM latest d WHERE d.\"row\" = latest.\"row\" AND d.ts = latest.ts AND "
        "d.family = 'view' AND d.qualifier = 'k10')",
    ),
    "cf_14_single_column_value": (
        lambda: CF.single_column_value("view", "k11", "=", "regexstring:^1"),
        f"{LATEST} WHERE NOT EXISTS (SELECT 1 FROM latest d WHERE d.\"row\" = latest.\"row\" AND d.family = 'view' AND "
        "d.qualifier = 'k11' AND NOT starts_with(d.value, '1'))",
    ),
    "cf_14_single_column_value_not": (
        lambda: CF.single_column_value("view", "k11", "!=", "regexstring:^1"),
        f"{LATEST} WHERE NOT EXISTS (SELECT 1 FROM latest d WHERE d.\"row\" = latest.\"row\" AND d.family = 'view' AND "
        "d.qualifier = 'k11' AND starts_with(d.value, '1'))",
    ),
    "cf_15_single_column_value_exclude": (
        lambda: CF.single_column_value("view", "k11", "=", "regexstring:^1", exclude=True),
        f"{LATEST} WHERE NOT EXISTS (SELECT 1 FROM latest d WHERE d.\"row\" = latest.\"row\" AND d.family = 'view' AND "
        "d.qualifier = 'k11' AND NOT starts_with(d.value, '1')) AND NOT (family = 'view' AND qualifier = 'k11')",
    ),
    "cf_16_column_range": (
        lambda: CF.column_range("k11", True, "k15", False), f"{LATEST} WHERE qualifier >= 'k11' AND qualifier < 'k15'",
    ),
    "cf_17_row_prefix": (lambda: CF.prefix("000000012"), f"{LATEST} WHERE \"row\" LIKE '000000012%'"),
    "cf_19_skip": (
        lambda: CF.skip(CF.matches("value", "!=", "regexstring:^77\\.")),
        f"{LATEST} WHERE \"row\" NOT IN (SELECT \"row\" FROM latest WHERE regexp_matches(value, '^77\\.'))",
    ),
    "cf_20_while_scan": (
        lambda: CF.while_(CF.matches("row", "!=", "substring:0090")),
        f"{LATEST} WHERE coalesce(\"row\" < (SELECT min(\"row\") FROM latest WHERE \"row\" LIKE '%0090%'), true)",
    ),
    "cf_20_while_row": (
        lambda: CF.while_(CF.matches("value", "!=", "regexstring:^5"), scope="row"),
        f"WITH {CELLS}, f AS (SELECT \"row\", min(family || '/' || qualifier) AS stop FROM latest WHERE "
        "regexp_matches(value, '^5') GROUP BY 1) SELECT l.* FROM latest l LEFT JOIN f USING (\"row\") "
        "WHERE stop IS NULL OR l.family || '/' || l.qualifier < stop",
    ),
}

for _name, (_step, _sql) in FILTERS.items():
    query(_name, _sql)(lambda t, step=_step: step()(C.latest(cells_of(t))))


@query("cf_18_and", f"WITH {CELLS} SELECT {_C} FROM (SELECT *, row_number() OVER (PARTITION BY \"row\" ORDER BY family, "
       "qualifier) AS pos FROM latest WHERE \"row\" LIKE '000000007%') WHERE pos <= 5")  # fmt: skip
def _(t):
    return C.scan(cells_of(t), filter_string="PrefixFilter('000000007') AND ColumnCountGetFilter(5)")


#: A filter string for every form, next to the query whose SQL it must equal.
STRINGS = {
    "cf_01_key_only": "KeyOnlyFilter()",
    "cf_02_first_key_only": "FirstKeyOnlyFilter()",
    "cf_03_multiple_column_prefix": "MultipleColumnPrefixFilter('k1', 'k25')",
    "cf_05_page": "PageFilter(10)",
    "cf_06_column_page": "ColumnPaginationFilter(3, 2)",
    "cf_07_inclusive_stop": "InclusiveStopFilter('0000000020')",
    "cf_08_row_regex": "RowFilter(!=, 'regexstring:[12]$')",
    "cf_09_timestamps": "TimestampsFilter(9001, 9002, 9003, 9004, 9005)",
    "cf_10_family": "FamilyFilter(=, 'substring:IE')",
    "cf_11_qualifier": "QualifierFilter(>, 'binary:k50')",
    "cf_13_dependent_column": "DependentColumnFilter('view', 'k10')",
    "cf_14_single_column_value": "SingleColumnValueFilter('view', 'k11', =, 'regexstring:^1')",
    "cf_15_single_column_value_exclude": "SingleColumnValueExcludeFilter('view', 'k11', =, 'regexstring:^1')",
    "cf_16_column_range": "ColumnRangeFilter('k11', true, 'k15', false)",
    "cf_19_skip": r"SKIP ValueFilter(!=, 'regexstring:^77\.')",
    "cf_20_while_scan": "WHILE RowFilter(!=, 'substring:0090')",
}

for _name, _text in STRINGS.items():
    query(f"{_name}_string", FILTERS[_name][1])(lambda t, text=_text: C.scan(cells_of(t), filter_string=text))
