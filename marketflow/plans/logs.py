"""Web access logs: parsing, quarantine, and traffic reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.dates import parse_apache_time
from marketflow.functions.numbers import safe_divide

# Fixed value: the common log format as nine groups.  (?U) gives \s and \w their Unicode meaning.
LOG_LINE = r'''(?U)^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)'''

GROUPS = "\n".join(f"${i}" for i in range(1, 10))

# The names of the nine groups.
FIELDS = [
    "host", "client_identd", "user_id", "date_time", "method",
    "endpoint", "protocol", "response_code", "content_size",
]


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """The nine typed fields, the raw line, whether the size was ``-``, and ``ok``.

    A line is not ok when it misses the pattern, or when its time or size cannot be read; its
    typed fields are then null.  A size of ``-`` counts as 0.
    """
    # The pattern runs once per line: matching lines become their nine groups, one per line break,
    # which a line of text cannot contain itself.  Exploding the one array keeps later filters from
    # repeating the pattern below this point.
    groups = F.split(F.regexp_replace(F.col(col), LOG_LINE + r"(?s:.*)$", GROUPS), "\n")
    raw = lines.select(F.col(col).alias("line"), F.explode(F.array(groups)).alias("_g")).select(
        "line",
        (F.size("_g") == 9).alias("_matched"),
        *[F.get("_g", F.lit(i)).alias(f"_{n}") for i, n in enumerate(FIELDS)],
    )
    dash = F.col("_content_size") == "-"
    typed = raw.select(
        "line",
        "_matched",
        *[F.col(f"_{n}").alias(n) for n in FIELDS if n not in ("date_time", "response_code", "content_size")],
        parse_apache_time(F.col("_date_time")).alias("date_time"),
        F.col("_response_code").try_cast("int").alias("response_code"),
        F.when(dash, 0).otherwise(F.col("_content_size").try_cast("int")).alias("content_size"),
        dash.alias("size_missing"),
    )
    ok = (
        F.col("_matched")
        & F.col("date_time").isNotNull()
        & F.col("response_code").isNotNull()
        & F.col("content_size").isNotNull()
    )
    return typed.select(
        "line",
        ok.alias("ok"),
        (ok & F.col("size_missing")).alias("size_missing"),
        *[F.when(ok, F.col(n)).alias(n) for n in FIELDS],
    )


def split_log(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, quarantined raw lines)."""
    return parsed.filter("ok").select(*FIELDS), parsed.filter("not ok").select("line")


def log_quality(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("ok").alias("parsed"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def bad_line_sample(parsed: DataFrame, n: int = 20) -> DataFrame:
    """The report's excerpt of failed lines; ordered so that reruns agree."""
    return parsed.filter("not ok").select("line").orderBy("line").limit(n)


def content_size_stats(logs: DataFrame) -> DataFrame:
    return logs.agg(
        F.avg("content_size").alias("avg_size"),
        F.avg("content_size").cast("long").alias("avg_size_int"),
        F.min("content_size").alias("min_size"),
        F.max("content_size").alias("max_size"),
    )


def status_counts(logs: DataFrame) -> DataFrame:
    return logs.groupBy("response_code").agg(F.count(F.lit(1)).alias("n")).orderBy("response_code")


def _day(by: str):
    """Day of month merges months, as the traffic report does; ``date`` keeps them apart."""
    if by == "day_of_month":
        return F.dayofmonth("date_time").alias("day")
    return F.to_date("date_time").alias("day")


def daily_hosts(logs: DataFrame, by: str = "day_of_month") -> DataFrame:
    return logs.groupBy(_day(by)).agg(F.count_distinct("host").alias("hosts"))


def daily_requests(logs: DataFrame, by: str = "day_of_month") -> DataFrame:
    return logs.groupBy(_day(by)).agg(F.count(F.lit(1)).alias("requests"))


def avg_requests_per_host(logs: DataFrame, by: str = "day_of_month") -> DataFrame:
    """Requests per distinct host and day.

    Requests are first counted per (day, host), which map tasks combine and which spreads a busy
    day over many tasks; the per-day row is then a sum over hosts.
    """
    per_host = logs.groupBy(_day(by), "host").agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_host.groupBy("day")
        .agg(F.count(F.lit(1)).alias("hosts"), F.sum("_n").alias("requests"))
        .withColumn("requests_per_host", safe_divide(F.col("requests"), F.col("hosts")))
        .orderBy("day")
    )


def size_placeholder_count(parsed: DataFrame) -> DataFrame:
    return parsed.agg(F.count_if("size_missing").alias("n"))
