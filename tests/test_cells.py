"""Cell visibility, mutations and filters on small tables."""

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from marketflow.operators import cell_filters as CF
from marketflow.operators import cells as C


def table(spark, data):
    """Tuples (row, family, qualifier, ts, value[, seq]); value None with family None deletes."""
    full = []
    for d in data:
        row, fam, qual, ts, value, *more = d
        full.append((row, fam, qual, ts, more[0] if more else 0, value, bool(len(more) > 1 and more[1])))
    return spark.createDataFrame(full, C.SCHEMA)


@pytest.fixture(scope="module")
def grid(spark):
    """10 rows x 3 families x 10 qualifiers, values cf1-ideval-xy."""
    data = [
        (f"row-{x}", f"cf{f}", f"c{x}{y}", 100 + y, f"cf{f}-ideval-{x}{y}")
        for x in range(10) for f in (1, 2, 3) for y in range(10)
    ]
    return table(spark, data).persist()


def test_ten_puts_under_one_timestamp_last_wins(spark):
    cells = table(spark, [("r", "f", "q", 5, f"v{i}", i) for i in range(10)])
    assert rows(C.latest(cells)) == [("r", "f", "q", 5, "v9")]
    assert C.versions(cells, 10).count() == 1


def test_older_put_after_row_delete_stays_hidden(spark):
    cells = table(spark, [("r", "entry", "num", 10, "a"), ("r", "entry", "foo", 10, "x")])
    cells = C.delete(cells, spark.createDataFrame([("r",)], "row string"), 20)
    later = table(spark, [("r", "entry", "num", t, str(t)) for t in (30, 40, 50, 1)])
    cells = cells.unionByName(later)
    assert rows(C.versions(cells, 10), "ts") == [(30,), (40,), (50,)]
    assert C.get_cell(cells, "r", "entry:num").first().value == "50"
    assert C.get_cell(cells, "r", "entry:foo").count() == 0


def test_delete_scopes(spark):
    cells = table(spark, [("r", f, q, t, f"{f}{q}{t}") for f in "ab" for q in "xy" for t in (1, 2, 3)])
    key = spark.createDataFrame([("r", "a", "x")], "row string, family string, qualifier string")
    left = C.delete(cells, key, 2)
    assert rows(C.all_versions(left).filter("family = 'a' and qualifier = 'x'"), "ts") == [(3,)]
    family = C.delete(cells, key.drop("qualifier"), 3)
    assert rows(C.latest(family), "family").count(("a",)) == 0
    assert C.latest(family).count() == 2
    row = C.delete(cells, key.select("row"), 2)
    assert rows(C.versions(row, 9), "ts") == [(3,)] * 4


def test_delete_wins_at_equal_timestamp_and_later_put_shows(spark):
    cells = table(spark, [("r", "f", "q", 5, "old")])
    cells = C.delete(cells, spark.createDataFrame([("r",)], "row string"), 5)
    assert C.latest(cells).count() == 0
    again = C.put(cells, spark.createDataFrame([("r", "f", "q", 6, "new")], "row string, family string, qualifier string, ts long, value string"))
    assert C.latest(again).first().value == "new"


def test_versions_and_as_of(spark):
    cells = table(spark, [("r", "f", "q", t, str(t)) for t in range(1, 11)])
    assert rows(C.versions(cells, 3), "ts") == [(10,), (8,), (9,)]
    assert rows(C.versions(cells, 2, as_of_ts=4), "ts") == [(3,), (4,)]


def test_scans(grid):
    assert C.scan(grid, start="row-1", stop="row-1").count() == 0
    assert rows(C.scan(grid, start="row-8").select("row").distinct()) == [("row-8",), ("row-9",)]
    keys = [r.row for r in C.scan(grid, reverse=True).collect()]
    assert keys == sorted(keys, reverse=True) and len(keys) == 300
    ordered = [(r.row, r.family, r.qualifier) for r in C.scan(grid).collect()]
    assert ordered == sorted(ordered)


def test_key_bounds_reach_the_scan(spark, grid, tmp_path):
    grid.write.parquet(str(tmp_path / "cells"))
    text = plan(C.scan(spark.read.parquet(str(tmp_path / "cells")), start="row-2", stop="row-4"))
    assert "GreaterThanOrEqual(row,row-2)" in text and "LessThan(row,row-4)" in text


def test_increment_and_append(spark):
    empty = spark.createDataFrame([], C.SCHEMA)
    ddl = "row string, family string, qualifier string, delta long"
    three = spark.createDataFrame([("k", "f", "n", 1)] * 3, ddl)
    cells = C.put(empty, C.increment(empty, three, 1))
    minus = C.increment(cells, spark.createDataFrame([("k", "f", "n", -1)], ddl), 2)
    assert minus.first().value == "2"
    text = spark.createDataFrame([("k", "f", "n", "!"), ("z", "f", "n", "a")], ddl.replace("delta long", "text string"))
    assert rows(C.append_values(cells, text, 9), "row", "value") == [("k", "3!"), ("z", "a")]
    two = text.withColumn("n", F.lit(2)).unionByName(text.withColumns({"n": F.lit(1), "text": F.lit("-")}))
    assert rows(C.append_values(cells, two, 9, order="n"), "row", "value") == [("k", "3-!"), ("z", "-a")]
    with pytest.raises(Exception, match="order column"):
        C.append_values(cells, two, 9).collect()


def test_values_that_are_no_counters(spark):
    cells = table(spark, [("k", "f", "n", 1, "12.5"), ("k", "f", "m", 1, "4")])
    ddl = "row string, family string, qualifier string, delta long"
    one = spark.createDataFrame([("k", "f", "n", 1), ("k", "f", "m", 1)], ddl)
    with pytest.raises(Exception, match="no counter"):
        C.increment(cells, one, 2).collect()
    assert rows(C.increment(cells, one, 2, skip_bad=True), "qualifier", "value") == [("m", "5")]


def test_puts_of_one_batch_keep_their_order(spark):
    ddl = "row string, family string, qualifier string, value string, n int"
    batch = spark.createDataFrame([("r", "f", "q", f"v{i}", i) for i in range(10)], ddl).repartition(7)
    empty = spark.createDataFrame([], C.SCHEMA)
    first = C.mutate(empty, batch, 5, order="n")
    assert rows(C.latest(first), "value") == [("v9",)]
    again = C.mutate(first, batch.filter("n = 0"), 5, number=1)
    assert rows(C.latest(again), "value") == [("v0",)]
    with pytest.raises(Exception, match="order column"):
        C.mutate(empty, batch, 5).collect()


def test_check_and_put(spark):
    cells = table(spark, [("r", "f", "q", 1, "v")])
    ddl = "row string, family string, qualifier string, expected string, value string, n int"
    tries = spark.createDataFrame(
        [("r", "f", "q", "v", "1", 2), ("r", "f", "z", None, "2", 2), ("r", "f", "z", None, "5", 1), ("r", "f", "q", None, "3", 1),
         ("x", "f", "q", "v", "4", 1)], ddl
    )
    assert rows(C.check_and_put(cells, tries, order="n").filter("passed"), "value") == [("1",), ("5",)]
    with pytest.raises(Exception, match="order column"):
        C.check_and_put(cells, tries).collect()


def test_prune(spark):
    cells = table(spark, [("r", f, "q", t, str(t)) for f in "abc" for t in range(1, 8)])
    kept = C.prune_versions(cells, {"a": 1, "b": 5}, ttl={"b": 2}, now=7)
    assert rows(kept.groupBy("family").count()) == [("a", 1), ("b", 3), ("c", 3)]


def test_wide_round_trip(spark):
    wide = spark.createDataFrame([("k1", 1.5, None), ("k2", 2.0, "x")], "k string, a double, b string")
    mapping = {"a": "F:A", "b": "F:B"}
    cells = C.wide_to_cells(wide, F.col("k"), mapping, 3)
    assert cells.count() == 3
    assert rows(C.cells_to_wide(cells, mapping)) == [("k1", "1.5", None), ("k2", "2.0", "x")]


def test_row_maps_split_wide_rows(grid):
    maps = C.as_row_maps(grid, page_cells=8)
    sizes = [len(r.cells) for r in maps.collect()]
    assert sum(sizes) == 300 and max(sizes) == 8
    assert maps.filter("row = 'row-1' and page = 0").first().cells["cf1:c10"].value == "cf1-ideval-10"


def test_value_filter_sample_matches_nothing(grid):
    assert CF.value_filter("=", "regexstring:^ideval")(C.latest(grid)).count() == 0


def test_single_column_value_keeps_rows_without_the_column(grid):
    step = CF.single_column_value("cf1", "c11", "=", "regexstring:cf1-ideval-11")
    two = CF.row_filter("=", "regexstring:row-[12]$")
    assert two(step(C.latest(grid))).count() == 60
    no = CF.single_column_value("cf1", "c11", "!=", "regexstring:cf1-ideval-11")
    assert rows(two(no(C.latest(grid))).select("row").distinct()) == [("row-2",)]
    cut = CF.single_column_value("cf1", "c11", "=", "regexstring:cf1-ideval-11", exclude=True)
    assert two(cut(C.latest(grid))).count() == 59


def test_while_and_skip(grid):
    stop = CF.while_(CF.matches("row", "!=", "substring:row-4"))
    assert rows(stop(C.latest(grid)).select("row").distinct()) == [(f"row-{i}",) for i in range(4)]
    per_row = CF.while_(CF.matches("qualifier", "!=", "binary:c33"), scope="row")(C.latest(grid))
    assert per_row.filter("row = 'row-3'").count() == 3
    assert per_row.filter("row <> 'row-3'").count() == 270
    skip = CF.skip(CF.matches("value", "!=", "binary:cf2-ideval-55"))
    assert skip(C.latest(grid)).filter("row = 'row-5'").count() == 0
    none = CF.while_(CF.matches("row", "!=", "substring:absent"))
    assert none(C.latest(grid)).count() == 300


def test_dependent_column_and_pages(grid):
    got = CF.dependent_column("cf1", "c11")(C.latest(grid))
    assert rows(got, "row", "qualifier") == [("row-1", "c11")] * 3
    assert CF.page(2)(C.latest(grid)).count() == 60
    paged = CF.column_page(3, 2)(C.latest(grid)).filter("row = 'row-7'")
    assert rows(paged, "family", "qualifier") == [("cf1", "c72"), ("cf1", "c73"), ("cf1", "c74")]


def test_unknown_comparator_is_refused():
    with pytest.raises(ValueError):
        CF.matches("row", "<", "substring:x")


def test_filter_strings_that_cannot_be_read():
    for text in ("", "NoSuchFilter()", "PageFilter(1) OR PageFilter(2)", "PageFilter(1) PageFilter(2)", "SKIP PageFilter(1)",
                 "PrefixFilter('a", "PrefixFilter(a)", "ValueFilter(=, 'nokind:x')", "ValueFilter(~, 'binary:x')"):
        with pytest.raises((ValueError, KeyError)):
            CF.compiled(text)
    assert len(CF.compiled("PrefixFilter('it''s, (so)') AND  WHILE ValueFilter( = ,'binary:x')")) == 2


def test_reads_of_the_table(spark, grid, tmp_path):
    path = str(tmp_path / "cells")
    grid.write.parquet(path)
    cells = spark.read.parquet(path)
    assert plan(C.latest(cells)).count("FileScan") <= 2
    assert plan(C.prune_versions(cells, {"cf1": 1, "cf2": 2})).count("FileScan") <= 3
    for step in (CF.page(2), CF.dependent_column("cf1", "c00"), CF.skip(CF.matches("value", "=", "substring:1"))):
        assert plan(step(C.latest(cells))).count("FileScan") <= 3
