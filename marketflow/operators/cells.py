"""Versioned cells ``(row, family, qualifier, ts) -> value`` as a long table.

A mutation is an appended row; reads resolve versions and deletes.  Columns: row, family,
qualifier string; ts bigint; seq bigint (position inside one batch); value string; is_delete
boolean.  A delete row with null qualifier covers a family, with null family too the whole row.
It hides every cell it covers with ``ts`` at or before its own, also one appended later.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions.dates import trade_date
from marketflow.functions.strings import contract_row_key
from marketflow.operators.aggregates import group_members
from marketflow.operators.cell_filters import compiled
from marketflow.operators.windows import top_per_key
from marketflow.session import stored

SCHEMA = (
    "row string, family string, qualifier string, ts bigint, seq bigint, value string, is_delete boolean"
)
COLUMN = ["row", "family", "qualifier"]


# --- visibility ------------------------------------------------------------------------------


def _hide_deleted(puts: DataFrame, cells: DataFrame, own_column: bool) -> DataFrame:
    """Puts not covered by a delete of their family or row, or (``own_column``) of their column.

    Marks of families and rows come from one read: per row, the newest mark of the row and a map of
    those of its families, of which a table has few.  A mark hides what is as old or older.
    """
    wide = (
        cells.filter(F.col("is_delete") & F.col("qualifier").isNull())
        .groupBy("row", "family").agg(F.max("ts").alias("dead_ts"))
        .groupBy(F.col("row").alias("_d_row")).agg(
            F.max(F.when(F.col("family").isNull(), F.col("dead_ts"))).alias("_row_ts"),
            F.map_from_entries(
                F.collect_list(F.when(F.col("family").isNotNull(), F.struct("family", "dead_ts")))
            ).alias("_family_ts"),
        )
    )
    joined = puts.join(wide, puts["row"] == F.col("_d_row"), "left")
    newest = F.greatest("_row_ts", F.try_element_at("_family_ts", F.col("family")))
    kept = joined.filter(newest.isNull() | (F.col("ts") > newest)).select(*puts.columns)
    if not own_column:
        return kept
    marks = cells.filter(F.col("is_delete") & F.col("qualifier").isNotNull())
    own = marks.groupBy(*[F.col(c).alias(f"_d_{c}") for c in COLUMN]).agg(F.max("ts").alias("_dead_ts"))
    match = F.col("ts") <= F.col("_dead_ts")
    for c in COLUMN:
        match = match & (F.col(c) == F.col(f"_d_{c}"))
    return kept.join(own, match, "left_anti")


def _puts(cells: DataFrame) -> DataFrame:
    return cells.filter(~F.col("is_delete"))


def latest(cells: DataFrame) -> DataFrame:
    """Newest visible value of every column: row, family, qualifier, ts, value.

    The newest put is picked first (``max_by`` combines map-side, so a column with a billion
    versions is one row per task); if a delete covers it, it covers all older ones too.  Deletes of
    the column itself share its key and are compared in the same aggregate.
    """
    is_put = ~F.col("is_delete")
    newest = cells.groupBy(*COLUMN).agg(
        F.max_by(F.when(is_put, F.struct("ts", "value")), F.when(is_put, F.struct("ts", "seq"))).alias("_c"),
        F.max(F.when(F.col("is_delete"), F.col("ts"))).alias("_dead"),
    )
    alive = newest.filter(F.col("_c").isNotNull() & (F.col("_dead").isNull() | (F.col("_c.ts") > F.col("_dead"))))
    return _hide_deleted(alive.select(*COLUMN, "_c.ts", "_c.value"), cells, own_column=False)


def all_versions(cells: DataFrame) -> DataFrame:
    """Every visible version; several puts at one timestamp are one version, the last in the batch."""
    per_ts = _puts(cells).groupBy(*COLUMN, "ts").agg(F.max_by("value", "seq").alias("value"))
    return _hide_deleted(per_ts, cells, own_column=True)


def as_of(cells: DataFrame, ts: int) -> DataFrame:
    """The table as it was: only mutations with a timestamp at or before ``ts``."""
    return cells.filter(F.col("ts") <= ts)


def versions(cells: DataFrame, n: int, as_of_ts: int | None = None) -> DataFrame:
    """The newest ``n`` visible versions of every column."""
    if as_of_ts is not None:
        cells = as_of(cells, as_of_ts)
    return top_per_key(all_versions(cells), COLUMN, [F.desc("ts")], n)


# --- reads -----------------------------------------------------------------------------------


def _wanted(columns: Sequence[str] | None, qualifier_regex: str | None) -> Column | None:
    """``['cf1', 'cf2:c7']`` as a predicate, so that it reaches the scan."""
    keep = None
    if columns is not None:
        keep = F.lit(False)
        for spec in columns:
            family, _, qualifier = spec.partition(":")
            one = F.col("family") == family
            keep = keep | (one & (F.col("qualifier") == qualifier) if qualifier else one)
    if qualifier_regex is not None:
        match = F.col("qualifier").rlike(qualifier_regex)
        keep = match if keep is None else keep & match
    return keep


def select_columns(
    cells: DataFrame, columns: Sequence[str] | None = None, qualifier_regex: str | None = None
) -> DataFrame:
    """Keep families, ``family:qualifier`` columns, or qualifiers matching a regex."""
    keep = _wanted(columns, qualifier_regex)
    return cells if keep is None else cells.filter(keep)


def get_rows(
    cells: DataFrame,
    rows: DataFrame,
    columns: Sequence[str] | None = None,
    as_of_ts: int | None = None,
) -> DataFrame:
    """Latest cells of the keys in ``rows`` (one column ``row``); unknown keys give nothing.

    The key join comes first, so versions of other rows are never resolved.
    """
    picked = cells.join(rows.select("row").distinct(), "row", "left_semi")
    if as_of_ts is not None:
        picked = as_of(picked, as_of_ts)
    return select_columns(latest(picked), columns)


def get_cell(cells: DataFrame, row: str, column: str) -> DataFrame:
    """Latest value of one column of one row; no rows when absent."""
    return select_columns(latest(cells.filter(F.col("row") == row)), [column])


@dataclass
class ScanSpec:
    start: str | None = None
    stop: str | None = None
    prefix: str | None = None
    ts: int | None = None
    columns: Sequence[str] | None = None
    qualifier_regex: str | None = None
    filters: Sequence = field(default_factory=tuple)
    filter_string: str | None = None
    reverse: bool = False


def scan(cells: DataFrame, spec: ScanSpec | None = None, **options) -> DataFrame:
    """Latest cells in key order; ``[start, stop)``, prefix, exact timestamp, columns, filters.

    Filters are steps of ``cell_filters`` or one filter string.

    Key bounds apply before versions are resolved and are plain comparisons on ``row``, which
    Parquet uses to skip row groups.  A start equal to the stop is an empty range.
    """
    spec = spec or ScanSpec(**options)
    if spec.start is not None:
        cells = cells.filter(F.col("row") >= spec.start)
    if spec.stop is not None:
        cells = cells.filter(F.col("row") < spec.stop)
    if spec.prefix is not None:
        cells = cells.filter(F.col("row").startswith(spec.prefix))
    if spec.ts is not None:
        found = all_versions(cells).filter(F.col("ts") == spec.ts)
    else:
        found = latest(cells)
    found = select_columns(found, spec.columns, spec.qualifier_regex)
    for keep in [*spec.filters, *(compiled(spec.filter_string) if spec.filter_string else [])]:
        found = keep(found)
    row = F.desc("row") if spec.reverse else F.asc("row")
    return found.orderBy(row, "family", "qualifier", F.desc("ts"))


def as_row_maps(cells: DataFrame, page_cells: int = 10_000) -> DataFrame:
    """Each row as maps ``family:qualifier -> (value, ts)``, in pages of ``page_cells`` from page 0.

    The resolved cells are stored first, because numbering them reads them more than once.
    """
    entry = F.struct(
        F.concat_ws(":", "family", "qualifier").alias("key"),
        F.struct("value", "ts").alias("value"),
    )
    packed = group_members(stored(latest(cells)), ["row"], entry, ["family", "qualifier"], page_cells)
    return packed.select("row", "page", F.map_from_entries("members").alias("cells"))


def count_rows(cells: DataFrame) -> DataFrame:
    return latest(cells).agg(F.count_distinct("row").alias("n"))


def list_families(cells: DataFrame) -> DataFrame:
    return latest(cells).select("family").distinct()


# --- mutations -------------------------------------------------------------------------------


def put(cells: DataFrame, changes: DataFrame, order: str | None = None, batch: int = 0) -> DataFrame:
    """Append puts; a missing ``is_delete`` is false.

    Several puts to one cell at one timestamp need an ``order`` column of whole numbers, the last of
    which wins; ``batch`` ranks whole batches.  Without ``order`` or ``seq`` such puts are refused.
    """
    if "is_delete" not in changes.columns:
        changes = changes.withColumn("is_delete", F.lit(False))
    if order is not None:
        changes = changes.withColumn("seq", F.lit(batch << 32) + F.col(order).cast("long"))
    elif "seq" not in changes.columns:
        changes = _alone(changes, [*COLUMN, "ts"]).withColumn("seq", F.lit(batch << 32).cast("long"))
    return cells.unionByName(changes.select(*cells.columns))


def _alone(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows``, which fail when two of them share all ``keys``."""
    rest = [c for c in rows.columns if c not in keys]
    packed = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
    refused = F.raise_error(F.lit("several rows for one cell need an order column"))
    checked = packed.withColumn("_row", F.when(F.col("_n") == 1, F.col("_row")).otherwise(refused))
    return checked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def mutate(cells: DataFrame, batch: DataFrame, ts: int, order: str | None = None, number: int = 0) -> DataFrame:
    """Append a batch of puts and deletes that share one timestamp, in the order of column ``order``."""
    return put(cells, batch.withColumn("ts", F.lit(ts).cast("long")), order, number)


def delete(cells: DataFrame, keys: DataFrame, ts: int) -> DataFrame:
    """Delete everything at or before ``ts`` in the scopes of ``keys``.

    ``keys`` has ``row`` and optionally ``family`` and ``qualifier``; a missing column widens the
    scope to the family or the row.
    """
    for c in ("family", "qualifier"):
        if c not in keys.columns:
            keys = keys.withColumn(c, F.lit(None).cast("string"))
    marks = keys.select(
        *COLUMN,
        F.lit(ts).cast("long").alias("ts"),
        F.lit(0).cast("long").alias("seq"),
        F.lit(None).cast("string").alias("value"),
        F.lit(True).alias("is_delete"),
    )
    return cells.unionByName(marks)


def prune_versions(
    cells: DataFrame, limits: dict[str, int], default: int = 3, ttl: dict[str, int] | None = None, now: int | None = None
) -> DataFrame:
    """Visible versions within each family's version limit and time-to-live.

    One numbering for all families: cut to the largest limit, which Catalyst does before the shuffle,
    and to the family's own after it.
    """
    rows = all_versions(cells)
    for family, age in (ttl or {}).items():
        rows = rows.filter((F.col("family") != family) | (F.col("ts") >= now - age))
    own = F.lit(default)
    for family, n in limits.items():
        own = F.when(F.col("family") == family, n).otherwise(own)
    newest = Window.partitionBy(*COLUMN).orderBy(F.desc("ts"))
    ranked = rows.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= max(default, *limits.values(), 0))
    return ranked.filter(F.col("_rn") <= own).drop("_rn")


def increment(cells: DataFrame, deltas: DataFrame, ts: int, skip_bad: bool = False) -> DataFrame:
    """Counter columns after adding all ``delta`` rows: the new cells, one per counter touched.

    A value that is no whole number is no counter: the job fails, or with ``skip_bad`` such cells are
    left as they are and out of the result.
    """
    added = deltas.groupBy(*COLUMN).agg(F.sum("delta").alias("_d"))
    now = latest(cells.join(added.select(*COLUMN), COLUMN, "left_semi").unionByName(_scope_deletes(cells)))
    joined = added.join(now.drop("ts"), COLUMN, "left")
    old = F.when(F.col("value").isNull(), F.lit(0).cast("long")).otherwise(F.col("value").try_cast("long"))
    if skip_bad:
        joined = joined.filter(old.isNotNull())
    else:
        refused = F.raise_error(F.concat(F.lit("no counter: "), F.col("value"))).cast("long")
        old = F.when(old.isNull(), refused).otherwise(old)
    return joined.select(
        *COLUMN, F.lit(ts).cast("long").alias("ts"), (old + F.col("_d")).cast("string").alias("value")
    )


def _scope_deletes(cells: DataFrame) -> DataFrame:
    """Row and family deletes, which a join on full column keys would lose."""
    return cells.filter(F.col("is_delete") & F.col("qualifier").isNull())


def _of_rows(cells: DataFrame, batch: DataFrame) -> DataFrame:
    """The cells of the rows a batch names, so that no other row is resolved."""
    return cells.join(batch.select("row").distinct(), "row", "left_semi")


def append_values(cells: DataFrame, texts: DataFrame, ts: int, order: str | None = None) -> DataFrame:
    """Cells with all their ``text`` appended to the current value, in the order of column ``order``.

    Without ``order`` two texts for one column are refused.
    """
    if order is None:
        joined = _alone(texts.select(*COLUMN, "text"), COLUMN)
    else:
        ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("text").alias("text"))))
        joined = texts.groupBy(*COLUMN).agg(F.array_join(ordered["text"], "").alias("text"))
    now = latest(_of_rows(cells, texts)).drop("ts")
    return joined.join(now, COLUMN, "left").select(
        *COLUMN,
        F.lit(ts).cast("long").alias("ts"),
        F.concat(F.coalesce("value", F.lit("")), F.col("text")).alias("value"),
    )


def check_and_put(cells: DataFrame, attempts: DataFrame, order: str | None = None) -> DataFrame:
    """For each attempt (row, family, qualifier, expected, value): whether its check passed.

    A null ``expected`` passes only when the column is absent.  Of several attempts on one cell the
    first by column ``order`` that fits the value passes, and no other; without ``order`` they are
    refused.  Feed the passing rows to ``put``.
    """
    if order is None:
        attempts = _alone(attempts, COLUMN).withColumn("_order", F.lit(0))
    else:
        attempts = attempts.withColumn("_order", F.col(order))
    now = latest(_of_rows(cells, attempts)).select(*COLUMN, F.col("value").alias("current"))
    fits = attempts.join(now, COLUMN, "left").withColumn("_fits", F.col("expected").eqNullSafe(F.col("current")))
    first = Window.partitionBy(*COLUMN, "_fits").orderBy("_order")
    ranked = fits.withColumn("passed", F.col("_fits") & (F.row_number().over(first) == 1))
    return ranked.drop("_order", "_fits")


# --- wide tables -----------------------------------------------------------------------------


def wide_to_cells(df: DataFrame, key: Column, mapping: dict[str, str], ts: Column | int) -> DataFrame:
    """Cells of the mapped columns (``{'OPEN': 'D:OPR'}``); null values give no cell."""
    entries = []
    for col, target in mapping.items():
        family, _, qualifier = target.partition(":")
        entries.append(
            F.struct(
                F.lit(family).alias("family"),
                F.lit(qualifier).alias("qualifier"),
                F.col(col).cast("string").alias("value"),
            )
        )
    stamp = ts if isinstance(ts, Column) else F.lit(ts)
    # The key is a column of its own first, so that it is built once per row and not per cell.
    keyed = df.select(key.alias("row"), stamp.cast("long").alias("ts"), *mapping)
    long = keyed.select("row", "ts", F.explode(F.array(*entries)).alias("_c"))
    return long.filter("_c.value is not null").select(
        "row", "_c.family", "_c.qualifier", "ts", F.lit(0).cast("long").alias("seq"), "_c.value",
        F.lit(False).alias("is_delete"),
    )


def cells_to_wide(cells: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """The inverse: one column per mapped cell column, one line per row key."""
    names = F.concat_ws(":", "family", "qualifier")
    targets = list(mapping.values())
    named = select_columns(latest(cells), targets).withColumn("_name", names)
    wide = named.groupBy("row").pivot("_name", targets).agg(F.first("value"))
    return wide.select("row", *[F.col(f"`{target}`").alias(col) for col, target in mapping.items()])


# The nine stored columns of a derivatives row and their short names.
BHAV_CELLS = {
    "OPEN": "D:OPR",
    "HIGH": "D:HPR",
    "LOW": "D:LPR",
    "CLOSE": "D:CPR",
    "SETTLE_PR": "D:SPR",
    "CONTRACTS": "D:CNTRS",
    "VAL_INLAKH": "D:VLKH",
    "OPEN_INT": "D:OI",
    "CHG_IN_OI": "D:CHGOI",
}


def bhav_to_cells(df: DataFrame, ts: Column | int) -> DataFrame:
    """Derivatives rows as cells under their contract row key."""
    key = contract_row_key(
        F.col("SYMBOL"), trade_date(F.col("EXPIRY_DT")), F.col("OPTION_TYP"), "STRIKE_PR",
        trade_date(F.col("TIMESTAMP")),
    )
    return wide_to_cells(df, key, BHAV_CELLS, ts)
