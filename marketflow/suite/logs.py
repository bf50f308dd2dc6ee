"""Access-log queries over lines rendered from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketflow.plans import logs as L
from marketflow.suite.derived import LOG, log_lines
from marketflow.suite.registry import query


def _parsed(t):
    return L.parse_access_log(log_lines(t))


def _good(t):
    return L.split_log(_parsed(t))[0]


@query(
    "log_01_parse_access_log",
    f"WITH {LOG} SELECT host, '-' AS client_identd, '-' AS user_id, date_time, method, endpoint, 'HTTP/1.0' AS protocol, "
    "response_code, content_size FROM log WHERE ok",
)
def _(t):
    return _good(t).withColumn("date_time", F.col("date_time").cast("timestamp_ntz"))


@query(
    "log_02_quality",
    f"WITH {LOG} SELECT count(*) AS lines, count(*) FILTER (ok) AS parsed, count(*) FILTER (NOT ok) AS failed FROM log",
)
def _(t):
    return L.log_quality(_parsed(t))


@query("log_02_quarantined", f"WITH {LOG} SELECT line FROM log WHERE NOT ok")
def _(t):
    return L.split_log(_parsed(t))[1]


@query("log_02_bad_line_sample", f"WITH {LOG} SELECT line FROM log WHERE NOT ok ORDER BY line LIMIT 20")
def _(t):
    return L.bad_line_sample(_parsed(t), 20)


@query(
    "log_03_content_size_stats",
    f"WITH {LOG} SELECT round(avg(content_size), 4) AS avg_size, trunc(avg(content_size))::BIGINT AS avg_size_int, "
    "min(content_size) AS min_size, max(content_size) AS max_size FROM log WHERE ok",
)
def _(t):
    return L.content_size_stats(_good(t)).withColumn("avg_size", F.round("avg_size", 4))


@query("log_04_status_counts", f"WITH {LOG} SELECT response_code, count(*) AS n FROM log WHERE ok GROUP BY 1")
def _(t):
    return L.status_counts(_good(t))


@query(
    "log_05_daily_hosts",
    f"WITH {LOG} SELECT day(date_time)::INTEGER AS day, count(DISTINCT host) AS hosts FROM log WHERE ok GROUP BY 1",
)
def _(t):
    return L.daily_hosts(_good(t))


@query(
    "log_06_daily_requests",
    f"WITH {LOG} SELECT date_time::DATE AS day, count(*) AS requests FROM log WHERE ok GROUP BY 1",
)
def _(t):
    return L.daily_requests(_good(t), by="date")


@query(
    "log_07_avg_requests_per_host",
    f"WITH {LOG} SELECT day(date_time)::INTEGER AS day, count(DISTINCT host) AS hosts, count(*) AS requests, "
    "round(count(*) / count(DISTINCT host), 6) AS requests_per_host FROM log WHERE ok GROUP BY 1",
)
def _(t):
    return L.avg_requests_per_host(_good(t)).withColumn("requests_per_host", F.round("requests_per_host", 6))


@query("log_08_size_placeholder_count", f"WITH {LOG} SELECT count(*) AS n FROM log WHERE ok AND size_missing AND value >= 3")
def _(t):
    return L.size_placeholder_count(_parsed(t))
