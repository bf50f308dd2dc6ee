"""Nested movie records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the record's fields.
MOVIE_SCHEMA = (
    "title string, country string, year int, "
    "`cast` struct<Director:string,LeadActor:string,BoxOfficeUSDMn:double>, "
    "genres array<string>, ratings map<string,double>"
)


def movie_ratings(df: DataFrame) -> DataFrame:
    """Rating totals per lead actor."""
    return df.groupBy(F.col("cast.LeadActor").alias("leadactor")).agg(
        F.sum(F.try_element_at("ratings", F.lit("imdb"))).alias("imdbtot"),
        F.sum(F.try_element_at("ratings", F.lit("tomatoes"))).alias("tomtot"),
    )
