"""Bounded samples of labelled documents for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: With more label values than this a sample has fewer rows of each, so that it stays as large as with so many.
VALUES = 64
SALTS = 32


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, allowed: Column | None = None, later: str | None = None
) -> DataFrame:
    """(doc_id, text, label) of up to ``rows`` labelled documents for every value of ``label``.

    The choice follows a hash of doc_id, so it is the same at every run and spread over the table; rows
    with a true column ``later`` come after all others.  Ids are picked from the labels alone, a few per
    value in every task before they are shuffled; the join then brings the texts of those picked.
    Null ids and null labels are left out; a doc_id labelled twice takes its largest label.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if allowed is not None:
        known = known.where(allowed)
    last = F.lit(False) if later is None else F.min(later)
    known = known.groupBy("doc_id").agg(F.max(label).alias(label), last.alias("later"))
    values = known.select(label).distinct().count()
    each = rows if values <= VALUES else max(1, VALUES * rows // values)
    order = ["later", F.xxhash64("doc_id"), "doc_id"]
    # a frequent value is cut down by SALTS tasks first, so that the last one gets SALTS * rows at most
    picked = known.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(SALTS)))
    for part in ([label, "salt"], [label]):
        nth = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        picked = picked.withColumn("nth", nth).where(F.col("nth") <= each)
    picked = picked.select("doc_id", label)
    few = F.broadcast(picked)  # at most VALUES * rows pairs, or one for each value
    return docs.select("doc_id", "text").join(few, "doc_id")
