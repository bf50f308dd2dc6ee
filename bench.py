"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run twice into a no-op sink and the faster run counts, so that JVM warm-up and code
generation are not what is measured.  Building the query is part of its time: window queries
sample their keys, and stream and snapshot queries run jobs while they are built.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from marketflow.session import build_session
from marketflow.suite import load

HEADLINE = [
    "mkt_06_market_direction", "mkt_04_pcr_by_contracts", "mkt_05_pcr_by_open_interest",
    "mkt_07_combine_grouped_and_pcr", "mkt_09_final_pl", "mkt_11_moving_averages", "mkt_12_sequence_prices",
    "mkt_16_upsert", "mkt_17_oi_summary", "log_01_parse_access_log", "log_04_status_counts",
    "log_07_avg_requests_per_host", "ag_01_group_agg", "ag_17_histogram", "ag_19_cube", "ag_22_grouping_sets",
    "jn_06_left_outer", "jn_10_anti_join", "jn_14_pair_join", "jn_16_zip_by_position",
    "wn_01_running_sum_range", "wn_01_running_sum_hot_key", "wn_04_moving_avg", "wn_04_moving_avg_hot_key",
    "wn_07_lagged", "cl_01_latest", "cl_02_versions", "cl_24_bhav_to_cells", "cf_14_single_column_value",
    "cf_20_while_row", "js_02_parse_json", "mov_01_movie_ratings", "str_02_words", "st_04_word_counts",
    "st_09_quote_windows", "vt_06_merge_insert", "src_22_read_by_key",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
