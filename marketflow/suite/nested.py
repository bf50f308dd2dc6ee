"""Arrays, maps, structs, JSON and encoded payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.functions.numbers import geometric_mean
from marketflow.operators import nested as X
from marketflow.plans.movies import MOVIE_SCHEMA, movie_ratings
from marketflow.suite.registry import query


def _numbers(t):
    """Key and an array of ints per embedding: all its dimensions in thousandths."""
    whole = F.transform("embedding", lambda v: F.floor(v.cast("double") * 1000).cast("int"))
    return t.embeddings.select(F.col("vec_id").alias("key"), whole.alias("values"))


NUMBERS = """
nums AS (SELECT vec_id AS key, list_transform(embedding, lambda v: floor(v::DOUBLE * 1000)::INTEGER) AS vals
  FROM embeddings)
"""


def _text(col):
    return F.array_join(F.transform(col, lambda v: v.cast("string")), ",")


def _sql_text(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda z: z::VARCHAR), ',')"


@query("ar_01_element", f"WITH {NUMBERS} SELECT key, vals[1] AS first, vals[len(vals) + 1] AS beyond FROM nums")
def _(t):
    return _numbers(t).select(
        "key", F.col("values")[0].alias("first"), F.get("values", F.size("values")).alias("beyond")
    )


@query("ar_02_explode", f"WITH {NUMBERS} SELECT key, unnest(vals) AS element FROM nums")
def _(t):
    return X.explode_array(_numbers(t), "values").select("key", "element")


def _behind_a_path(t):
    """Numbers two structs deep; embeddings of an even label have a null there."""
    odd = F.when(F.col("label") % 2 != 0, F.col("values"))
    labelled = _numbers(t).join(t.embeddings.select(F.col("vec_id").alias("key"), "label"), "key")
    return labelled.select("key", F.struct(F.struct(odd.alias("odd")).alias("numbers")).alias("info"))


@query(
    "ar_03_explode_outer",
    f"WITH {NUMBERS} SELECT key, unnest(vals) AS element FROM nums JOIN embeddings ON vec_id = key WHERE label % 2 <> 0 "
    "UNION ALL SELECT vec_id, NULL FROM embeddings WHERE label % 2 = 0",
)
def _(t):
    return X.explode_array(_behind_a_path(t), "info.numbers.odd", outer=True).select("key", "element")


def _nested(t):
    v = F.col("values")
    return _numbers(t).select("key", F.array(F.slice(v, F.lit(1), F.lit(2)), F.slice(v, F.lit(3), F.size(v))).alias("nested_values"))


@query("ar_04_flatten", f"WITH {NUMBERS} SELECT key, {_sql_text('vals')} AS flat FROM nums")
def _(t):
    return _nested(t).select("key", _text(F.flatten("nested_values")).alias("flat"))


@query(
    "ar_05_transform",
    f"WITH {NUMBERS} SELECT key, {_sql_text('list_transform(vals, lambda x: x + 1)')} AS plus_one FROM nums",
)
def _(t):
    return _numbers(t).select("key", _text(F.transform("values", lambda v: v + 1)).alias("plus_one"))


@query(
    "ar_06_transform_capture",
    f"WITH {NUMBERS} SELECT key, {_sql_text('list_transform(vals, lambda x: x + key)')} AS plus_key FROM nums",
)
def _(t):
    return _numbers(t).select("key", _text(F.transform("values", lambda v: v + F.col("key"))).alias("plus_key"))


@query(
    "ar_07_nested_transform",
    f"WITH {NUMBERS} SELECT key, {_sql_text('list_transform(vals[1:2], lambda x: x + key + 2)')} || ';' || "
    f"{_sql_text('list_transform(vals[3:], lambda x: x + key + len(vals) - 2)')} AS nested FROM nums",
)
def _(t):
    changed = F.transform(
        "nested_values", lambda inner: F.transform(inner, lambda v: v + F.col("key") + F.size(inner))
    )
    return _nested(t).select("key", F.array_join(F.transform(changed, _text), ";").alias("nested"))


@query(
    "ar_08_exists",
    f"WITH {NUMBERS} SELECT key, len(list_filter(vals, lambda x: x % 10 = 1)) > 0 AS found FROM nums",
)
def _(t):
    return _numbers(t).select("key", F.exists("values", lambda v: v % 10 == 1).alias("found"))


@query(
    "ar_09_filter",
    f"WITH {NUMBERS} SELECT key, {_sql_text('list_filter(vals, lambda x: x > 50)')} AS above FROM nums",
)
def _(t):
    return _numbers(t).select("key", _text(F.filter("values", lambda v: v > 50)).alias("above"))


@query(
    "ar_10_reduce",
    f"WITH {NUMBERS} SELECT key, list_sum(vals)::INTEGER AS summed, (list_sum(vals) * 2)::INTEGER AS finished FROM nums",
)
def _(t):
    return _numbers(t).select(
        "key",
        F.reduce("values", F.lit(0), lambda acc, v: acc + v).alias("summed"),
        F.reduce("values", F.lit(0), lambda acc, v: acc + v, lambda acc: acc * 2).alias("finished"),
    )


@query(
    "ar_11_geometric_mean",
    f"WITH {NUMBERS} SELECT key, round(power(list_product(list_transform(vals, lambda x: abs(x)::DOUBLE + 1)), 1.0 / len(vals)), 6) "
    "AS geomean FROM nums",
)
def _(t):
    positive = F.transform("values", lambda v: F.abs(v) + 1)
    return _numbers(t).select("key", F.round(geometric_mean(positive), 6).alias("geomean"))


@query(
    "ar_12_build_array",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey || ',' || l_partkey || ';' || l_suppkey AS built FROM lineitem",
)
def _(t):
    nested = F.array(F.array("l_orderkey", "l_partkey"), F.array("l_suppkey"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.array_join(F.transform(nested, _text), ";").alias("built"),
    )


def _movies(t):
    """Orders in the shape of a movie record: customer = lead actor, two ratings per order."""
    return t.orders.select(
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderstatus").alias("country"),
        F.year("o_orderdate").alias("year"),
        F.struct(
            F.col("o_orderpriority").alias("Director"),
            F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("LeadActor"),
            F.col("o_totalprice").alias("BoxOfficeUSDMn"),
        ).alias("cast"),
        F.array("o_orderstatus", "o_orderpriority").alias("genres"),
        F.create_map(
            F.lit("imdb"), (F.col("o_orderkey") % 10).cast("double"),
            F.lit("tomatoes"), (F.col("o_custkey") % 5).cast("double"),
        ).alias("ratings"),
    )


MOVIES = """
mv AS (SELECT 'T' || o_orderkey AS title, o_orderstatus AS country, year(o_orderdate)::INTEGER AS year,
    o_orderpriority AS director, 'A' || o_custkey AS leadactor, o_totalprice AS box,
    (o_orderkey % 10)::DOUBLE AS imdb, (o_custkey % 5)::DOUBLE AS tomatoes FROM orders)
"""


@query("mp_01_map_value", f"WITH {MOVIES} SELECT title, imdb, tomatoes FROM mv")
def _(t):
    return _movies(t).select("title", "ratings.imdb", F.col("ratings")["tomatoes"].alias("tomatoes"))


@query(
    "mp_02_explode_map",
    f"WITH {MOVIES} SELECT title, 'imdb' AS key, imdb AS value FROM mv UNION ALL SELECT title, 'tomatoes', tomatoes FROM mv",
)
def _(t):
    return X.explode_map(_movies(t), "ratings").select("title", "key", "value")


@query(
    "mp_03_explode_chain",
    f"WITH {MOVIES} SELECT title, g AS genre, k AS rating, CASE k WHEN 'imdb' THEN imdb ELSE tomatoes END AS score "
    "FROM (SELECT *, unnest([country, director]) AS g FROM mv) CROSS JOIN (VALUES ('imdb'), ('tomatoes')) r(k)",
)
def _(t):
    rows = X.explode_chain(_movies(t), ["genres"], ["ratings"])
    return rows.select(
        "title",
        F.col("genres_item").alias("genre"),
        F.col("ratings_key").alias("rating"),
        F.col("ratings_value").alias("score"),
    )


@query("mp_04_field", f"WITH {MOVIES} SELECT title, director, leadactor FROM mv")
def _(t):
    return _movies(t).select(
        "title", F.col("cast.director").alias("director"), F.col("CAST.leadActor").alias("leadactor")
    )


@query("mp_05_struct", "SELECT c_custkey, c_name AS name, c_nationkey AS nation FROM customer")
def _(t):
    built = t.customer.select("c_custkey", F.struct("c_name", "c_nationkey").alias("s"))
    return built.select("c_custkey", F.col("s.c_name").alias("name"), F.col("s.c_nationkey").alias("nation"))


@query(
    "mov_01_movie_ratings",
    f"WITH {MOVIES} SELECT leadactor, sum(imdb) AS imdbtot, sum(tomatoes) AS tomtot FROM mv GROUP BY 1",
)
def _(t):
    return movie_ratings(_movies(t))


def _movie_json(t):
    return _movies(t).select(F.to_json(F.struct("*")).alias("mjson"))


@query(
    "js_01_json_path",
    f"WITH {MOVIES} SELECT title, director, '\"LeadActor\":\"' || leadactor || '\"' AS lead FROM mv",
)
def _(t):
    return _movie_json(t).select(
        F.get_json_object("mjson", "$.title").alias("title"),
        F.get_json_object("mjson", "$.cast.Director").alias("director"),
        F.regexp_extract(F.get_json_object("mjson", "$.cast"), '("LeadActor":"[^"]*")', 1).alias("lead"),
    )


@query("js_02_parse_json", f"WITH {MOVIES} SELECT title, country, year, leadactor, imdb FROM mv")
def _(t):
    rows = X.parse_json(_movie_json(t), "mjson", MOVIE_SCHEMA, "mdet").select("mdet.*")
    return rows.select("title", "country", "year", F.col("cast.LeadActor").alias("leadactor"), "ratings.imdb")


@query(
    "js_03_to_json",
    "SELECT '{\"k\":' || o_orderkey || CASE WHEN o_orderstatus = 'P' THEN '' ELSE ',\"s\":\"' || o_orderstatus || '\"' END "
    "|| '}' AS json FROM orders",
)
def _(t):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    rows = t.orders.select(F.col("o_orderkey").alias("k"), status.alias("s"))
    return X.to_json_column(rows, ["k", "s"])


@query("src_08_json_inferred", f"WITH {MOVIES} SELECT title, country, year::BIGINT AS year, leadactor FROM mv")
def _(t):
    rows = X.json_strings_to_df(_movie_json(t), "mjson")
    return rows.select("title", "country", "year", F.col("cast.LeadActor").alias("leadactor"))


@query("src_09_json_schema", f"WITH {MOVIES} SELECT title, country, year, box, tomatoes FROM mv")
def _(t):
    rows = X.json_strings_to_df(_movie_json(t), "mjson", MOVIE_SCHEMA)
    return rows.select("title", "country", "year", F.col("cast.BoxOfficeUSDMn").alias("box"), "ratings.tomatoes")


@query("av_01_encode_decode", f"WITH {MOVIES} SELECT director, leadactor, box FROM mv")
def _(t):
    packed = X.encode_struct(_movies(t).select("cast"), "cast")
    schema = "Director string, LeadActor string, BoxOfficeUSDMn double"
    rows = X.decode_struct(packed, "payload", schema)
    return rows.select(
        F.col("record.Director").alias("director"),
        F.col("record.LeadActor").alias("leadactor"),
        F.col("record.BoxOfficeUSDMn").alias("box"),
    )
