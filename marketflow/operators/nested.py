"""Arrays, maps, structs and JSON or encoded payload columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def explode_array(df: DataFrame, path: str, name: str = "element", outer: bool = False) -> DataFrame:
    """All columns plus one row per element; ``outer`` keeps rows whose array is null or empty."""
    generate = F.explode_outer if outer else F.explode
    return df.select("*", generate(F.col(path)).alias(name))


def explode_map(df: DataFrame, path: str, key: str = "key", value: str = "value") -> DataFrame:
    return df.select("*", F.explode(F.col(path)).alias(key, value))


def explode_chain(df: DataFrame, arrays: Sequence[str], maps: Sequence[str] = ()) -> DataFrame:
    """Explode several columns one after another: the product of their elements per row."""
    for a in arrays:
        df = explode_array(df, a, f"{a}_item")
    for m in maps:
        df = explode_map(df, m, f"{m}_key", f"{m}_value")
    return df


def parse_json(df: DataFrame, col: str, schema: T.StructType | str, name: str = "parsed") -> DataFrame:
    """Add the parsed struct; malformed text gives a struct of nulls."""
    return df.withColumn(name, F.from_json(col, schema))


def _plain(kind: T.DataType) -> T.DataType:
    """Inferred type as a JSON reader would give it: fractions are doubles, mixed values text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, (T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(kind, T.DecimalType) and (kind.scale > 0 or kind.precision <= 18):
        return T.DoubleType()
    return kind


def infer_json_schema(df: DataFrame, col: str) -> T.StructType:
    """Merged schema of a column of JSON texts, as one aggregate that combines map-side.

    Malformed texts are left out of the inference.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(col))).alias("s")).first().s
    # Names may be quoted; OBJECT is the variant word for a struct.
    outside = found.split("`")
    outside[::2] = [part.replace("OBJECT<", "STRUCT<") for part in outside[::2]]
    return _plain(T.DataType.fromDDL("`".join(outside)))


def json_strings_to_df(df: DataFrame, col: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A column of JSON texts as a table.

    Without a schema the texts are read twice: a pass that infers it and the parse itself.
    """
    if schema is None:
        schema = infer_json_schema(df, col)
    return df.select(F.from_json(col, schema).alias("_row")).select("_row.*")


def to_json_column(df: DataFrame, cols: Sequence[str], name: str = "json") -> DataFrame:
    """One JSON text per row; null fields are left out."""
    return df.select(F.to_json(F.struct(*cols)).alias(name))


def encode_struct(df: DataFrame, col: str, name: str = "payload") -> DataFrame:
    """Struct column -> binary payload, for sinks that carry only key and value."""
    return df.withColumn(name, F.to_json(col).cast("binary")).drop(col)


def decode_struct(df: DataFrame, col: str, schema: T.StructType | str, name: str = "record") -> DataFrame:
    return df.withColumn(name, F.from_json(F.col(col).cast("string"), schema)).drop(col)
