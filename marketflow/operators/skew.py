"""Ordered groups that may be far larger than one task.

A window over ``partitionBy(keys)`` puts every row of a key into one task.  That is the right
plan while keys are small, and the wrong one when a single symbol holds a third of the table.
``find_hot_keys`` samples the key and order columns once and, for each key that is too large,
picks order values that cut it into ranges; the windows in ``windows.py`` then work per range and
carry what crosses a cut.  Rows are never dropped: cold keys simply have no cuts.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A hot key is cut into ranges of about a quarter of an average task, so that hashing the ranges
# to tasks comes out even.
RANGES_PER_TASK = 4
ROWS_PER_CUT = 12
#: Rows that one task should take; with it the table's own size decides which key is hot.
ROWS_PER_TASK = 1_000_000
#: Bounds what is sampled to the driver (ROWS_PER_CUT narrow rows each) and broadcast (one cut each).
#: Beyond MAX_RANGES * ROWS_PER_TASK / RANGES_PER_TASK rows ranges grow instead; no row is left out.
MAX_RANGES = 65_536


@dataclass
class HotKeys:
    """Cut points of the hot keys: at most one row per key, MAX_RANGES cuts in all.

    A row's range is a function of its own key and order values, so a task that is run again gives
    the same answer, and rows that tie on the order share a range.  ``heavy_ties`` tells that one
    order value alone fills a task.
    """

    keys: list[str]
    order: list[str]
    table: DataFrame
    longest: int
    heavy_ties: bool

    def _match(self, df: DataFrame, how: str) -> DataFrame:
        cuts = self.table.toDF(*[f"_hot_{k}" for k in self.keys], "_cuts")
        match = F.lit(True)
        for k in self.keys:
            match = match & F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
        # Bounded: find_hot_keys keeps at most MAX_RANGES cut points over all keys.
        return df.join(F.broadcast(cuts), match, how)

    def _ranged(self, joined: DataFrame) -> DataFrame:
        """Count the cuts at or before each row, by steps of falling powers of two.

        One projection per step keeps the search in generated code.  Past the end of the array the
        comparison is null, so the step is not taken.
        """
        probe = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(self.order)])
        at = F.col("_range")
        found = joined.withColumns({"_probe": probe, "_range": F.lit(0)})
        for step in [2**i for i in reversed(range(self.longest.bit_length()))]:
            taken = F.get("_cuts", at + (step - 1)) <= F.col("_probe")
            found = found.withColumn("_range", F.when(taken, at + step).otherwise(at))
        return found.withColumn("_range", F.when(F.col("_cuts").isNotNull(), at)).drop(
            "_cuts", "_probe", *[f"_hot_{k}" for k in self.keys]
        )

    def tag(self, df: DataFrame) -> DataFrame:
        """All rows with ``_range``: 0.. for rows of hot keys, null for the others."""
        return self._ranged(self._match(df, "left"))

    def hot(self, df: DataFrame) -> DataFrame:
        """Rows of hot keys with their ``_range``."""
        return self._ranged(self._match(df, "inner"))

    def cold(self, df: DataFrame) -> DataFrame | None:
        """Rows of the other keys; None when the whole table is one group."""
        return self._match(df, "left_anti") if self.keys else None


def find_hot_keys(
    df: DataFrame, keys: list[str], order: list[str], tasks: int | None = None
) -> HotKeys | None:
    """Keys larger than one and a half average tasks, or None when there are none.

    ``tasks`` defaults to as many as the rows need at ``ROWS_PER_TASK`` each, whatever the session's
    settings are.  Two narrow jobs run: a row count, and a row-wise sample of about ``ROWS_PER_CUT``
    rows per range.  With no ``keys`` the whole table is one group.
    """
    spark = df.sparkSession
    total = df.count()
    if total == 0:
        return None
    if tasks is None:
        tasks = -(-total // ROWS_PER_TASK)
        if keys and tasks == 1:
            return None  # no key can be larger than a task
    ranges = max(2, min(tasks * RANGES_PER_TASK, MAX_RANGES))
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    ordered = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).alias("_at")
    fraction = min(1.0, ranges * ROWS_PER_CUT / total)
    draw = df.select(*named, ordered).sample(fraction, seed=11)
    rows = draw.orderBy(*[f"k{i}" for i in range(len(keys))], "_at").collect()
    per_cut = max(2, min(ROWS_PER_CUT, len(rows) // ranges))
    floor = int(1.5 * RANGES_PER_TASK * per_cut)
    hot, longest, heavy_ties = [], 0, False
    for key, members in groupby(rows, key=lambda r: tuple(r[:-1])):
        at = [m[-1] for m in members]
        if len(at) <= floor and keys:
            continue
        cuts, repeats = [], 0
        for cut in at[per_cut::per_cut]:
            if cuts and cut == cuts[-1]:
                repeats += 1
                heavy_ties = heavy_ties or repeats >= RANGES_PER_TASK
            else:
                cuts.append(cut)
                repeats = 0
        if cuts:
            hot.append((*key, cuts))
            longest = max(longest, len(cuts))
    if not hot:
        return None
    schema = T.StructType(
        [*draw.schema.fields[:-1], T.StructField("_cuts", T.ArrayType(draw.schema["_at"].dataType))]
    )
    table = spark.createDataFrame(hot, schema)
    return HotKeys(list(keys), list(order), table, longest, heavy_ties)
