"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact shingles.

An item is found in a document when the document holds at least 80 % of the item's distinct five-word
shingles, wherever they stand.  Items are put into partitions by size (powers of two of their
distinct shingles).  The partition fixes how many of an item's smallest hashes form its sketch: as
many as may be missing at the partition's upper size, and a few more.  At 80 % containment only a
known number of shingles can be missing, so a known number of sketch values must occur in the
document: documents with fewer are no candidates, and none that matters is lost, however long
it is.  Hashes above the largest sketch value are left out before anything is joined.

Candidates are verified on the shingles' own text.  Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.shipping import fresh_name
from marketflow.session import stored

SHINGLE = 5
LEAST_CONTAINMENT = 0.8
#: Sketch values beyond those that may be missing.
EXTRA = 4
#: Tables of sketch values, item shingles or candidate ids are broadcast up to this many rows.
BROADCAST_ROWS = 200_000

SEPARATORS = r"[\x20\x09-\x0D]+"


def lower_words(text: Column) -> Column:
    """Lower-case words; null and empty texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` and its lambdas name it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_texts(words: Column, n: int = SHINGLE) -> Column:
    """Distinct shingles of n words; fewer words are one shingle, no words none."""

    def cut(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
        one = F.array(F.array_join(w, " "))
        return F.when(F.size(w) >= n, many).when(F.size(w) > 0, one).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(bound(words, cut))


def shingle_hashes(words: Column, n: int = SHINGLE) -> Column:
    """Distinct hashes of the shingles, from one hash per word."""

    def cut(h: Column) -> Column:
        many = F.transform(
            F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)])
        )
        one = F.array(F.aggregate(h, F.lit(0).cast("long"), lambda s, x: F.xxhash64(s, x)))
        return F.when(F.size(h) >= n, many).when(F.size(h) > 0, one).otherwise(F.array().cast("array<long>"))

    return F.array_distinct(bound(F.transform(words, lambda w: F.xxhash64(w)), cut))


def least_shared(n: Column, containment: float) -> Column:
    """How many of n shingles make up ``containment``."""
    return F.ceil(n * F.lit(containment) - F.lit(1e-9)).cast("int")


def sketch_items(items: DataFrame, containment: float, extra: int) -> DataFrame:
    """(item_id, partition, n_item, least_matches, hash): the sketch of every item with words."""
    shingled = (
        items.select("item_id", lower_words(F.col("text")).alias("words"))
        .select("item_id", F.explode(shingle_hashes(F.col("words"))).alias("hash"))
        .groupBy("item_id").agg(F.sort_array(F.collect_set("hash")).alias("hashes"))
        .withColumn("n_item", F.size("hashes"))
        .withColumn("partition", F.floor(F.log2(F.col("n_item").cast("double"))).cast("int"))
    )
    upper = (F.pow(F.lit(2.0), F.col("partition") + 1) - 1).cast("int")
    size = F.least(F.col("n_item"), upper - least_shared(upper, containment) + 1 + extra)
    missing = F.col("n_item") - least_shared(F.col("n_item"), containment)
    return (
        shingled.withColumn("size", size)
        .withColumn("least_matches", F.greatest(F.lit(1), F.col("size") - missing))
        .select(
            "item_id", "partition", "n_item", "least_matches",
            F.explode(F.slice("hashes", F.lit(1), F.col("size"))).alias("hash"),
        )
    )


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint when its counted size allows it."""
    return F.broadcast(df) if df.count() <= rows else df


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    containment: float = LEAST_CONTAINMENT,
    extra: int = EXTRA,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every item found in a document.

    Rows of one doc_id, or of one item_id, count as one text cut into parts; a null id is an id like
    others.  Null or wordless texts match nothing.  A text of fewer than five words is one shingle.
    Repeated rows change nothing; empty tables give no rows; other columns are ignored.
    """
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    sketch = stored(sketch_items(items, containment, extra), "item-sketch")
    bound = sketch.agg(F.max("hash")).first()[0]
    if bound is None:
        return _verified(docs, items, sketch.select(F.lit(None).cast("long").alias("doc_id"), "item_id"), containment)
    hashed = docs.select(
        "doc_id",
        F.explode(F.filter(shingle_hashes(lower_words(F.col("text"))), lambda h: h <= F.lit(bound))).alias("hash"),
    )
    matches = (
        hashed.join(_small(sketch, broadcast_rows), "hash")
        .groupBy("doc_id", "item_id", "least_matches").agg(F.countDistinct("hash").alias("n"))
    )
    candidates = matches.where(F.col("n") >= F.col("least_matches")).select("doc_id", "item_id")
    return _verified(docs, items, stored(candidates, "leak-candidates"), containment, broadcast_rows)


def _verified(
    docs: DataFrame, items: DataFrame, candidates: DataFrame, containment: float, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Exact containment of the candidate pairs, by the text of the shingles."""
    parts = (
        items.join(candidates.select(F.col("item_id").alias("__item")).distinct(), F.col("item_id").eqNullSafe(F.col("__item")), "left_semi")
        .select("item_id", F.explode(shingle_texts(lower_words(F.col("text")))).alias("shingle")).distinct()
    )
    sizes = parts.groupBy("item_id").agg(F.count("*").alias("n_item"))
    ids = _small(candidates.select(F.col("doc_id").alias("__doc")).distinct(), broadcast_rows)
    own = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("__doc")), "left_semi").select(
        "doc_id", F.explode(shingle_texts(lower_words(F.col("text")))).alias("shingle")
    )
    wanted = stored(parts.join(sizes.withColumnRenamed("item_id", "__item"), F.col("item_id").eqNullSafe(F.col("__item"))).drop("__item"), "item-shingles")
    pairs = candidates.select(F.col("doc_id").alias("__doc"), F.col("item_id").alias("__item")).distinct()
    shared = (
        own.join(_small(wanted, broadcast_rows), "shingle")
        .groupBy("doc_id", "item_id", "n_item").agg(F.countDistinct("shingle").alias("n_shared"))
        .where(F.col("n_shared") >= least_shared(F.col("n_item"), containment))
    )
    both = F.col("doc_id").eqNullSafe(F.col("__doc")) & F.col("item_id").eqNullSafe(F.col("__item"))
    return shared.join(pairs, both, "left_semi").select(
        "doc_id", "item_id", "n_item", "n_shared",
        (F.col("n_shared").cast("double") / F.col("n_item")).alias("containment"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, containment: float = LEAST_CONTAINMENT) -> DataFrame:
    """The rows of ``docs`` in which no item is contained."""
    found = contained_items(docs, items, containment)
    leak = fresh_name(docs, "leak")
    hit = stored(found.select(F.col("doc_id").alias(leak)).distinct(), "leaking-ids")
    return docs.join(_small(hit, BROADCAST_ROWS), docs["doc_id"].eqNullSafe(hit[leak]), "left_anti")


#: The same by brute force: every shingle of every document against every shingle of every item.
ORACLE = """
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM dw
), its AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM iw
), n AS (SELECT item_id, count(*) AS n_item FROM its GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*)::DOUBLE / n_item AS containment
FROM ds JOIN its USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 10 >= n_item * 8
"""
