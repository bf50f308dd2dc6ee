"""Window analytics over ordered groups.

Each function first looks for hot keys (see ``skew.py``).  Without any, the plan is the plain
window a Spark user would write: one shuffle on the keys.  With some, the hot keys are handled by
order range.  Order columns are ascending; numbering needs them to be a total order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketflow.operators.skew import ROWS_PER_TASK, find_hot_keys

BLOCK_ROWS = 65_536
#: Frames of up to this many preceding rows are cheaper added up than sorted again.
SHORT_FRAME = 32


def _rejoin(cold: DataFrame | None, hot: DataFrame, columns: list[str]) -> DataFrame:
    hot = hot.select(*columns)
    return hot if cold is None else cold.select(*columns).unionByName(hot)


def _carried(hot_rows: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """Per (key, range): each total summed over the earlier ranges of that key.

    One row per range, so the window below sees at most MAX_RANGES rows in all.
    """
    per_range = hot_rows.groupBy(*keys, "_range").agg(*[c.alias(n) for n, c in totals.items()])
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    return per_range.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        F.col("_range").alias("_c_range"),
        *[F.sum(n).over(before).alias(f"_c_{n}") for n in totals],
    )


def _with_carried(hot_rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    match = F.col("_range") == F.col("_c_range")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    # Bounded: one row per range.
    return hot_rows.join(F.broadcast(carried), match, "left").drop(
        "_c_range", *[f"_c_{k}" for k in keys]
    )


def order_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tasks: int | None = None
) -> DataFrame:
    """Add ``_range`` and ``_before``: how many rows of the key lie in earlier ranges.

    A numbering of the key is then ``row_number()`` per (keys, _range) plus ``_before``.  Keys that
    are not hot are one range with nothing before it.
    """
    keys, order = list(keys), list(order)
    nothing = F.lit(0).cast("long")
    hot = find_hot_keys(df, keys, order, tasks)
    if hot is None:
        return df.withColumns({"_range": F.lit(0), "_before": nothing})
    carried = _carried(hot.hot(df), keys, {"n": F.count(F.lit(1))})
    return (
        _with_carried(hot.tag(df), carried, keys)
        .withColumn("_before", F.coalesce(F.col("_c_n"), nothing))
        .drop("_c_n")
    )


def _numbered(ranged: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    within = F.row_number().over(W.partitionBy(*keys, "_range").orderBy(*order))
    return ranged.withColumn(name, within + F.col("_before")).drop("_range", "_before")


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rno",
    tasks: int | None = None,
) -> DataFrame:
    """``row_number()`` per key as a bigint column; with no keys, one global numbering.

    A global numbering never runs in one task: the whole table counts as a hot key.
    """
    keys, order = list(keys), list(order)
    return _numbered(order_ranges(df, keys, order, tasks), keys, order, name)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    frame: str = "range",
    tasks: int | None = None,
) -> DataFrame:
    """Running totals per key, one output column per entry of ``sums``.

    ``frame='range'`` is SQL's default for an ordered window: rows that tie on ``order`` all get
    the total including every tied row.  ``frame='rows'`` counts row by row and needs a total
    order.  Hot keys are summed per order range and the totals of earlier ranges are added; ties
    never straddle a range, so both frames stay exact.
    """
    keys, order = list(keys), list(order)
    hot = find_hot_keys(df, keys, order, tasks)

    def over(part: list[str]):
        spec = W.partitionBy(*part).orderBy(*order)
        if frame == "rows":
            return spec.rowsBetween(W.unboundedPreceding, W.currentRow)
        return spec.rangeBetween(W.unboundedPreceding, W.currentRow)

    if hot is None:
        return df.withColumns({n: F.sum(c).over(over(keys)) for n, c in sums.items()})
    carried = _carried(hot.hot(df), keys, {n: F.sum(c) for n, c in sums.items()})
    if frame == "rows" or not hot.heavy_ties:
        # one reading and one shuffle for all rows: those of other keys have no range and nothing carried
        tagged = hot.tag(df)
        summed = tagged.withColumns({n: F.sum(c).over(over([*keys, "_range"])) for n, c in sums.items()})
        return _with_earlier(summed, carried, keys, sums).select(*df.columns, *sums)
    # One date alone holds a large part of a key, so its rows are added up before the window
    # and the total is joined back; adaptive execution splits the large side of that join.
    cold, hot_rows = hot.cold(df), hot.hot(df)
    if cold is not None:
        cold = cold.withColumns({n: F.sum(c).over(over(keys)) for n, c in sums.items()})
    peers = hot_rows.groupBy(*keys, "_range", *order).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    totals = peers.withColumns({n: F.sum(n).over(over([*keys, "_range"])) for n in sums})
    right = totals.toDF(*[c if c in sums else f"_p_{c}" for c in totals.columns])
    match = F.lit(True)
    for c in [*keys, "_range", *order]:
        match = match & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    summed = hot_rows.join(right, match).select(*hot_rows.columns, *sums)
    return _rejoin(cold, _with_earlier(summed, carried, keys, sums), [*df.columns, *sums])


def _with_earlier(summed: DataFrame, carried: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Sums within a range plus those of the key's earlier ranges."""
    return _with_carried(summed, carried, keys).withColumns(
        {n: _plus(F.col(n), F.col(f"_c_{n}")) for n in sums}
    )


def _plus(total: Column, earlier: Column) -> Column:
    """Sum of two partial sums, either of which is null when it saw no value."""
    return F.when(total.isNull(), earlier).when(earlier.isNull(), total).otherwise(total + earlier)


def overlapping_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    depth: int,
    number: str | None = None,
    tasks: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``_block`` and ``_copy`` so that windows may run per (keys, _block).

    Hot keys are numbered and cut into blocks of ``block_rows`` rows; the last ``depth`` rows of a
    block are repeated in front of the next one, marked as copies.  A frame that looks at most
    ``depth`` rows back is then complete in every block.  Drop the copies after the window.
    ``number`` names a column for the row number within the key.
    """
    keys, order = list(keys), list(order)
    whole = {"_block": F.lit(0).cast("long"), "_copy": F.lit(False)}
    numbering = F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long")
    hot = find_hot_keys(df, keys, order, tasks)
    if hot is None:
        return (df if number is None else df.withColumn(number, numbering)).withColumns(whole)
    rno = number or "_rno"
    hot_rows = hot.hot(df)
    carried = _carried(hot_rows, keys, {"before": F.count(F.lit(1))})
    ranged = _with_carried(hot_rows, carried, keys).withColumn(
        "_before", F.coalesce("_c_before", F.lit(0).cast("long"))
    )
    size = max(block_rows, depth)
    at = F.col(rno) - 1
    block = F.floor(at / size)
    both = F.when(at % size >= size - depth, F.array(block, block + 1)).otherwise(F.array(block))
    copied = (
        _numbered(ranged, keys, order, rno)
        .withColumn("_block", F.explode(both))
        .withColumn("_copy", F.col("_block") > block)
    )
    cold = hot.cold(df)
    if cold is not None:
        cold = (cold if number is None else cold.withColumn(number, numbering)).withColumns(whole)
    return _rejoin(cold, copied, [*df.columns, *([number] if number else []), *whole])


def rows_back(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    depth: int,
    columns: Callable[[W], dict[str, Column]],
    **tuning,
) -> DataFrame:
    """Window columns that look at most ``depth`` rows back (ROWS frames and lags).

    ``columns`` receives the ordered window and returns the columns to add.
    """
    blocks = overlapping_blocks(df, keys, order, depth, **tuning)
    spec = W.partitionBy(*keys, "_block").orderBy(*order)
    return blocks.withColumns(columns(spec)).filter(~F.col("_copy")).drop("_block", "_copy")


def moving_avg(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    col: str,
    windows: dict[str, int],
    **tuning,
) -> DataFrame:
    """``ROWS n PRECEDING`` averages: ``windows`` maps output name to n, each over n+1 rows.

    Spark adds such a frame up anew for every row, so beyond ``SHORT_FRAME`` rows a row's work would
    grow with n.  Longer frames are put together from two running sums, see :func:`_lap_sums`.
    """
    blocks = overlapping_blocks(df, keys, order, max(windows.values()), **tuning)
    part = [*keys, "_block"]
    spec = W.partitionBy(*part).orderBy(*order)
    short = {name: n for name, n in windows.items() if n <= SHORT_FRAME}
    long = {name: n for name, n in windows.items() if n > SHORT_FRAME}
    out = blocks.withColumns({name: F.avg(col).over(spec.rowsBetween(-n, 0)) for name, n in short.items()})
    if long:
        kind = df.select(F.avg(col).alias("a")).schema["a"].dataType
        out = out.withColumn("_at", F.row_number().over(spec) - 1)
        for name, n in long.items():
            out = _lap_sums(out, part, col, n).withColumn(name, (F.col("_sum") / F.col("_count")).cast(kind))
    out = out.filter(~F.col("_copy"))
    return out.select(*df.columns, *windows)


def _lap_sums(df: DataFrame, part: list[str], col: str, n: int) -> DataFrame:
    """``_sum`` and ``_count`` of ``col`` over each row and the n before it, in constant work per row.

    Rows are numbered by ``_at`` within ``part`` and cut into laps of n+1 rows.  A frame is the begin of
    its row's own lap and the end of the lap before it: a running sum forwards, and the running
    sum backwards of the row n places earlier.  Nothing is subtracted, so doubles lose no digits.
    All windows are clustered by ``part``: there are sorts, but no further shuffle.
    """
    laps = df.withColumn("_lap", F.floor(F.col("_at") / (n + 1)))
    lap = W.partitionBy(*part, "_lap")
    ahead = lap.orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)
    back = lap.orderBy(F.desc("_at")).rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = laps.withColumns({"_sum": F.sum(col).over(ahead), "_count": F.count(col).over(ahead)})
    summed = summed.withColumns({"_end": F.sum(col).over(back), "_ends": F.count(col).over(back)})
    spec = W.partitionBy(*part).orderBy("_at")
    before = summed.withColumns({"_end": F.lag("_end", n).over(spec), "_ends": F.lag("_ends", n).over(spec)})
    whole = F.col("_at") % (n + 1) == n  # the frame is the lap, whose end is not to be counted twice
    return before.withColumns(
        {
            "_sum": F.when(whole, F.col("_sum")).otherwise(_plus(F.col("_sum"), F.col("_end"))),
            "_count": F.when(whole, F.col("_count")).otherwise(F.col("_count") + F.coalesce("_ends", F.lit(0))),
        }
    ).drop("_lap", "_end", "_ends")


def lagged(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, steps: Sequence[int], **tuning
) -> DataFrame:
    """``{col}_{n}`` = value n rows earlier in the key, null where there is none."""

    def lags(spec):
        return {f"{col}_{n}": F.lag(col, n).over(spec) for n in steps}

    return rows_back(df, keys, order, max(steps), lags, **tuning)


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, skip: int = 0
) -> DataFrame:
    """Rows ``skip+1 .. n`` of each key in the given order.

    Catalyst cuts each map task to n rows per key before the shuffle while n is small
    (``WindowGroupLimit``).  Beyond its threshold a salted first pass does the same job: every row,
    equal ones too, goes to one of as many salts as leave about ``ROWS_PER_TASK`` rows to the last
    pass.  With n near that size there is nothing to gain, and one pass does.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    salts = ROWS_PER_TASK // n if n else 0
    if n > threshold and salts > 1:
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts))
        first = W.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_rn", F.row_number().over(first))
            .filter(F.col("_rn") <= n)
            .drop("_salt", "_rn")
        )
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter((F.col("_rn") <= n) & (F.col("_rn") > skip)).drop("_rn")
